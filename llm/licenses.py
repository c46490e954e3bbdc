"""Licence scan: TF-IDF cosine of headers, blocks and whole files to templates, and inheritance by directory.

The lines of a text, its blocks (lines without an empty one between them, as a header wrapped over several lines) and the
whole text are sparse vectors of their words' counts times their inverse document frequency over all documents;
templates are vectors likewise. A file's own licence is the template nearest to one of its units. A file without
one inherits from the licence file in the nearest directory above it.

A unit that is near a template has one of the template's strong words, by Cauchy and Schwarz; units without a
strong word of any template are never made into vectors.
"""

from __future__ import annotations

import math
import re
from collections import Counter

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from llm.graph import kept
from llm.license_texts import TEMPLATES

#: The least cosine of a licence.
NEAR = 0.8
_TOKEN = r"[a-z0-9]+(?:[.-][a-z0-9]+)*"
_LICENCE_FILE = r"(?i)^(licen[cs]e|copying|notice)([.-].*)?$"
_BLANK_LINE = r"\n[ \t\r*#/;-]*\n"


def _tokens(text: Column) -> Column:
    return F.regexp_extract_all(F.lower(text), F.lit(_TOKEN), F.lit(0))


def _words(text: str) -> Counter:
    return Counter(re.findall(_TOKEN, text.lower()))


def _idf(n: int, count: Column | int) -> Column | float:
    return F.log((n + 1) / (count + 1)) + 1 if isinstance(count, Column) else math.log((n + 1) / (count + 1)) + 1


def _template_units(templates: dict[str, list[str]], idf: dict[str, float], near: float) -> tuple[list[dict[str, float]], list[str], list[str]]:
    """The templates as unit vectors, their licences, and the strong words of all of them.

    The rarest words are strong: those without which less than ``near`` of a template's length is left.
    """
    units, names, strong = [], [], set()
    for name, texts in templates.items():
        for text in texts:
            raw = {w: n * idf[w] for w, n in _words(text).items()}
            norm = math.sqrt(sum(x * x for x in raw.values()))
            units.append({w: x / norm for w, x in raw.items()})
            names.append(name)
            left = 1.0
            for w in sorted(units[-1], key=lambda w: (-idf[w], w)):
                if left < near * near:
                    break
                strong.add(w)
                left -= units[-1][w] ** 2
    return units, names, sorted(strong)


def scan(
    docs: DataFrame,
    id: str = "doc_id",
    text: str = "text",
    path: str = "path",
    templates: dict[str, list[str]] | None = None,
    near: float = NEAR,
) -> DataFrame:
    """One row per file: id, path, own_license, cosine, license, from_directory.

    ``license`` is the file's own or else that of the licence file in the nearest directory above,
    its own included; ``from_directory`` tells which. A licence file is one that is named so and
    has a licence, or whose whole text is as near to a template. Of equally near templates the first by name counts, of several
    licence files in a directory the first by path, then by licence. Null and empty texts have no licence of their own; a
    null path has no directory; equal rows are reported each; texts of any length are read whole; an empty table gives
    no rows and other columns don't matter.
    """
    spark = docs.sparkSession
    templates = TEMPLATES if templates is None else templates
    vocabulary = sorted({w for texts in templates.values() for t in texts for w in _words(t)})
    slim = docs.select(F.col(id).alias("id"), F.col(path).alias("path"), F.col(text).alias("text"))
    words = slim.select(F.explode(F.array_distinct(_tokens(F.col("text")))).alias("word"))
    counts = kept(words.groupBy("word").agg(F.count("*").alias("docs")), "document-frequencies")
    n = slim.count()
    found = dict(counts.where(F.col("word").isin(vocabulary)).collect())
    idf = {w: _idf(n, found.get(w, 0)) for w in vocabulary}
    vectors, names, strong = _template_units(templates, idf, near)
    weights = spark.createDataFrame(
        [(w, k, x) for k, unit in enumerate(vectors) for w, x in sorted(unit.items())], "word string, template int, weight double"
    )
    strong = F.array(*[F.lit(w) for w in strong])
    has = lambda t: F.arrays_overlap(t, strong)
    body = F.coalesce(F.col("text"), F.lit(""))
    lines = F.filter(F.transform(F.split(body, "\n"), _tokens), has)
    # The one-element explodes are fences: without them the optimizer would copy a step into each of its uses.
    near_lines = slim.select("id", "path", "text", F.explode(F.array(lines)).alias("lines"))
    blocks = F.when(F.size("lines") > 0, F.filter(F.transform(F.split("text", _BLANK_LINE), _tokens), has))
    units = near_lines.select("id", "path", "text", "lines", F.explode(F.array(blocks)).alias("blocks"))
    whole = F.when(F.col("blocks").isNotNull(), F.array(_tokens(F.col("text")))).otherwise(F.array().cast("array<array<string>>"))
    files = kept(
        units.select(
            F.monotonically_increasing_id().alias("row"), "id", "path",
            F.concat("lines", F.coalesce("blocks", F.array().cast("array<array<string>>")), whole).alias("units"),
        ),
        "licence-units",
    )
    # the whole text is the last unit
    unit_words = files.where(F.size("units") > 0).select("row", F.size("units").alias("all"), F.posexplode("units").alias("unit", "words"))
    bags = (
        unit_words.select("row", "unit", (F.col("unit") == F.col("all") - 1).alias("whole"), F.explode("words").alias("word"))
        .groupBy("row", "unit", "whole", "word")
        .agg(F.count("*").alias("n"))
        .join(counts, "word")
        .select("row", "unit", "whole", "word", (F.col("n") * _idf(n, F.col("docs"))).alias("weight_"))
    )
    bags = kept(bags, "licence-words")
    lengths = bags.groupBy("row", "unit").agg(F.sqrt(F.sum(F.col("weight_") * F.col("weight_"))).alias("length"))
    # the templates are in the code: some thousands of words
    products = (
        bags.join(F.broadcast(weights), "word")
        .groupBy("row", "unit", "whole", "template")
        .agg(F.sum(F.col("weight_") * F.col("weight")).alias("product"))
        .join(lengths, ["row", "unit"])
    )
    licences = F.array(*[F.lit(x) for x in names])
    nearest = products.groupBy("row").agg(
        F.min(F.struct(_far(F.col("product"), F.col("length")).alias("far"), F.get(licences, F.col("template")).alias("name"))).alias("own"),
        F.max(F.when(F.col("whole"), -_far(F.col("product"), F.col("length")))).alias("whole"),
    )
    judged = files.select("row", "id", "path").join(nearest, "row", "left")
    own = F.when(F.col("own.far") <= -near, F.col("own"))
    name = F.regexp_extract(F.coalesce("path", F.lit("")), r"([^/]*)$", 1)
    is_file = (own.isNotNull() & name.rlike(_LICENCE_FILE)) | (F.col("whole") >= near)
    scanned = kept(
        judged.select(
            "id",
            "path",
            F.when(F.col("path").contains("/"), F.regexp_replace("path", r"/[^/]*$", "")).alias("directory"),
            own["name"].alias("own_license"),
            F.coalesce(-own["far"], F.lit(0.0)).alias("cosine"),
            F.coalesce(is_file, F.lit(False)).alias("is_file"),
        ),
        "scanned",
    )
    return _inherited(scanned)


def _far(product: Column, length: Column) -> Column:
    """The cosine with its sign turned, rounded so that ties are ties."""
    return -F.round(F.try_divide(product, length), 9)


def _inherited(scanned: DataFrame) -> DataFrame:
    files = kept(
        scanned.where("is_file AND own_license IS NOT NULL")
        .groupBy(F.col("directory").alias("above"))
        .agg(F.min(F.struct("path", "own_license")).alias("file"))
        .select("above", F.col("file.own_license").alias("above_license")),
        "files",
    )
    parts = F.split("directory", "/")
    above = F.transform(F.sequence(F.lit(1), F.size(parts)), lambda k: F.array_join(F.slice(parts, 1, k), "/"))
    nearest = (
        scanned.where("directory IS NOT NULL")
        .select("directory")
        .distinct()
        .select("directory", F.explode(above).alias("above"))
        .join(files, "above")
        .groupBy("directory")
        .agg(F.max(F.struct(F.length("above").alias("depth"), "above", "above_license")).alias("nearest"))
    )
    inherits = F.col("own_license").isNull() & F.col("nearest").isNotNull()
    return scanned.join(kept(nearest, "directories"), "directory", "left").select(
        "id",
        "path",
        "own_license",
        "cosine",
        F.coalesce("own_license", "nearest.above_license").alias("license"),
        F.when(inherits, F.col("nearest.above")).alias("from_directory"),
    )
