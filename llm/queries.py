"""The registered queries of this subpackage: each operator over its whole table."""

from __future__ import annotations

import os
import tempfile
import zipfile
from collections.abc import Callable
from functools import wraps

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from llm import bpe
from llm.centroids import clustered
from llm.decontamination import leaks
from llm.divergence import source_divergence
from llm.embedding_dedup import embedding_classes
from llm.jaccard_join import jaccard_classes
from llm.licenses import scan
from llm.line_dedup import DENSE, line_report
from llm.mixing import mixed_sizes
from llm.quality import LEVEL, judged, train
from llm.substring_dedup import repeated_words
from llm.tool_calls import SCHEMAS, linked_calls, turns_as_calls
from llm.url_filter import judged_urls

_SHIPPED: set[str] = set()
#: Text that a Python task is handed at a time: 10,000 rows, Spark's own bound, may be long documents.
BATCH_BYTES = "8m"


def ship(spark: SparkSession) -> SparkSession:
    """Send the modules that tasks import to the executors, once for each application, and bound their batches."""
    context = spark.sparkContext
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", BATCH_BYTES)
    if context.applicationId not in _SHIPPED:
        top = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
        archive = os.path.join(tempfile.mkdtemp(prefix="modules-"), "corpus_modules.zip")
        with zipfile.ZipFile(archive, "w") as out:
            for package in ("llm", "meterflow"):
                for folder, _, names in os.walk(os.path.join(top, package)):
                    for name in names:
                        if name.endswith(".py"):
                            path = os.path.join(folder, name)
                            out.write(path, os.path.relpath(path, top))
        context.addPyFile(archive)
        _SHIPPED.add(context.applicationId)
    return spark


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _shipped(query: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    @wraps(query)
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return query(ship(spark), sf_dir)

    return run


def toxicity_grades(labels: DataFrame) -> DataFrame:
    """(doc_id, grade): 0 toxic, 1 of low quality, 2 neither; null without both ratings."""
    grade = F.when(F.col("toxic") == 1, 0).when(F.col("quality") == 0, 1).when(F.col("toxic") == 0, F.lit(2))
    return labels.select("doc_id", F.when(F.col("quality").isNotNull(), grade).alias("grade"))


def op1_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The verdict on each page's URL."""
    return judged_urls(table(spark, sf_dir, "pages"), whole=True).withColumnRenamed("id", "page_id")


def op2_source_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What the mix takes of each document."""
    return mixed_sizes(table(spark, sf_dir, "documents")).withColumnRenamed("id", "doc_id")


def op3_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What each document loses of passages of 50 words that an earlier one has."""
    return repeated_words(table(spark, sf_dir, "documents")).withColumnRenamed("id", "doc_id")


def op4_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Classes of documents with near sets of five-word shingles."""
    return jaccard_classes(table(spark, sf_dir, "documents")).withColumnRenamed("id", "doc_id")


def op5_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The documents that the classifier selects, with their expected grade and tail probability."""
    docs = table(spark, sf_dir, "documents")
    model = train(docs, toxicity_grades(table(spark, sf_dir, "labels")))
    return judged(docs, model).where(F.col("tail_probability") >= LEVEL).withColumnRenamed("id", "doc_id")


def op6_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What each document loses of repeated runs of lines."""
    return line_report(table(spark, sf_dir, "documents"), spacing=DENSE).withColumnRenamed("id", "doc_id")


def op7_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Licences of the documents, read as files: 64 to a directory below their source, short ones named COPYING."""
    docs = table(spark, sf_dir, "documents")
    name = F.when(F.length("text") < 1000, F.concat(F.lit("COPYING."), "doc_id")).otherwise(F.concat("doc_id", F.lit(".txt")))
    path = F.concat_ws("/", F.lit(""), "source", F.floor(F.col("doc_id") / 64).cast("string"), name)
    return scan(docs.select("doc_id", "text", path.alias("path"))).withColumnRenamed("id", "doc_id")


def op8_benchmark_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The benchmark items found in documents, and where."""
    return (
        leaks(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
        .withColumnRenamed("id", "doc_id")
        .withColumnRenamed("item", "item_id")
    )


def op9_chat_formatting(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The turns of the conversations as tool calls with their results."""
    calls, results = turns_as_calls(table(spark, sf_dir, "conversations"))
    return linked_calls(calls, results, SCHEMAS)


def op10_embedding_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Near-duplicates among the embeddings of each label."""
    return embedding_classes(table(spark, sf_dir, "embeddings")).withColumnRenamed("id", "vec_id")


def op11_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Digests of each document's ids, and of what they decode to."""
    import public_tokenizers

    path = public_tokenizers.path("word_bpe_49k.json")
    rows = bpe.decoded(bpe.encoded(table(spark, sf_dir, "documents"), path), path)
    return rows.select(
        F.col("id").alias("doc_id"),
        F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.array_join(F.col("ids").cast("array<string>"), " "), 256).alias("ids_sha256"),
        F.sha2("text", 256).alias("decoded_sha256"),
    )


def op12_source_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How the sources of each language differ in their words."""
    return source_divergence(table(spark, sf_dir, "documents"))


def op13_centroid_clusters(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The embeddings in eight clusters."""
    return clustered(table(spark, sf_dir, "embeddings")).withColumnRenamed("id", "vec_id")


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: _shipped(f) for f in (
        op1_url_filter,
        op2_source_mixing,
        op3_substring_dedup,
        op4_jaccard_join,
        op5_quality_classifier,
        op6_line_dedup,
        op7_license_scan,
        op8_benchmark_decontamination,
        op9_chat_formatting,
        op10_embedding_dedup,
        op11_bpe,
        op12_source_divergence,
        op13_centroid_clusters,
    )
}


def _rounds_sql(rounds: int = 10) -> str:
    """Centroids and assignments of each round, one after the other."""
    parts = []
    for k in range(rounds + 1):
        parts.append(f"""
        d{k} AS MATERIALIZED (
            SELECT x.r, c.cluster, sum((x.v - c.v) * (x.v - c.v))::BIGINT AS distance
            FROM x JOIN c{k} c USING (i) GROUP BY ALL),
        a{k} AS MATERIALIZED (
            SELECT r, min(distance) AS distance, arg_min(cluster, {{'d': distance, 'c': cluster}}) AS cluster FROM d{k} GROUP BY r)""")
        if k < rounds:
            parts.append(f"""
        m{k} AS (SELECT cluster, i, sum(v::HUGEINT) AS total, count(*) AS n
                 FROM x JOIN a{k} USING (r) GROUP BY ALL),
        c{k + 1} AS MATERIALIZED (
            SELECT cluster, i, CASE WHEN n IS NULL THEN c.v
                   ELSE ((total - ((total % n) + n) % n) // n)::BIGINT END AS v
            FROM c{k} c LEFT JOIN m{k} USING (cluster, i))""")
    return ",".join(parts)


#: SQL for DuckDB where it can express a query.
ORACLE: dict[str, str] = {
    "op2_source_mixing": r"""
        WITH sized AS (
            SELECT doc_id, source, coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0)::BIGINT AS size
            FROM documents),
        sources AS (
            SELECT source, sum(size)::BIGINT AS source_size, 3.0::DOUBLE * sum(size)::DOUBLE AS bound,
                   (1 + (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3)::DOUBLE AS weight
            FROM sized GROUP BY source),
        levels AS (
            SELECT max((t.total - coalesce(
                       (SELECT sum(b.bound) FROM sources b WHERE b.bound / b.weight < a.bound / a.weight), 0.0))
                   / (SELECT sum(b.weight) FROM sources b WHERE b.bound / b.weight >= a.bound / a.weight)) AS level
            FROM sources a, (SELECT sum(source_size)::DOUBLE AS total FROM sources) t),
        rates AS (
            SELECT source, source_size, least(bound, level * weight) AS target,
                   CASE WHEN source_size > 0 THEN least(least(bound, level * weight) / source_size, 3.0) ELSE 1.0 END AS rate
            FROM sources, levels),
        drawn AS (
            SELECT doc_id, size, source_size, target, rate,
                   ('0x' || substr(md5('1' || coalesce(':' || doc_id, '')), 1, 13))::BIGINT / 4503599627370496.0::DOUBLE AS draw
            FROM sized JOIN rates ON sized.source IS NOT DISTINCT FROM rates.source)
        SELECT doc_id, size, source_size, target,
               (size * (floor(rate) + CASE WHEN draw < rate - floor(rate) THEN 1 ELSE 0 END))::BIGINT AS taken
        FROM drawn""",
    "op3_substring_dedup": r"""
        WITH words AS (
            SELECT doc_id, coalesce(regexp_extract_all(text, '[^\x20\x09-\x0D]+'), []) AS w FROM documents),
        stretches AS (
            SELECT doc_id, unnest(range(1, len(w) - 48)) AS i, w FROM words WHERE len(w) >= 50),
        named AS (SELECT doc_id, i, array_to_string(w[i:i + 49], ' ') AS name FROM stretches),
        firsts AS (SELECT name, min(doc_id) AS first FROM named GROUP BY name),
        hits AS (SELECT doc_id, i FROM named JOIN firsts USING (name) WHERE first < doc_id),
        places AS (SELECT doc_id, unnest(range(1, len(w) + 1)) AS i, unnest(w) AS word FROM words),
        marked AS (
            SELECT doc_id, i, word, bool_or(hits.i IS NOT NULL) OVER (
                       PARTITION BY doc_id ORDER BY i ROWS BETWEEN 49 PRECEDING AND CURRENT ROW) AS gone
            FROM places LEFT JOIN hits USING (doc_id, i)),
        results AS (
            SELECT doc_id, count(*) AS n_words, count(*) FILTER (gone) AS n_removed,
                   string_agg(word, ' ' ORDER BY i) FILTER (NOT gone) AS left_over
            FROM marked GROUP BY doc_id)
        SELECT doc_id, coalesce(n_words, 0) AS n_words, coalesce(n_removed, 0) AS n_removed,
               sha256(coalesce(left_over, '')) AS kept_sha256
        FROM words LEFT JOIN results USING (doc_id)""",
    "op4_jaccard_join": r"""
        WITH RECURSIVE words AS (
            SELECT doc_id, coalesce(regexp_extract_all(
                       translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                       '[^\x20\x09-\x0D]+'), []) AS w
            FROM documents),
        places AS (SELECT doc_id, w, unnest(range(1, greatest(len(w) - 3, 2))) AS i FROM words WHERE len(w) > 0),
        runs AS (SELECT DISTINCT doc_id, array_to_string(w[i:i + 4], ' ') AS run FROM places),
        sizes AS (SELECT doc_id, count(*) AS n FROM runs GROUP BY doc_id),
        common AS (
            SELECT x.doc_id AS a, y.doc_id AS b, count(*) AS n
            FROM runs x JOIN runs y ON x.run = y.run AND x.doc_id <> y.doc_id GROUP BY ALL),
        links AS (
            SELECT a, b FROM common JOIN sizes x ON x.doc_id = a JOIN sizes y ON y.doc_id = b
            WHERE 100 * common.n >= 75 * (x.n + y.n - common.n)),
        reached AS (
            SELECT doc_id, doc_id AS other FROM documents
            UNION SELECT reached.doc_id, links.b FROM reached JOIN links ON links.a = reached.other)
        SELECT doc_id, coalesce(any_value(sizes.n), 0) AS n_shingles, min(other) AS component_id
        FROM reached LEFT JOIN sizes USING (doc_id) GROUP BY doc_id""",
    "op12_source_divergence": r"""
        WITH texts AS (
            SELECT row_number() OVER () AS d, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
                   regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                       '[^\x00-\x40\x5B-\x60\x7B-\x7F]+') AS w
            FROM documents),
        terms AS (SELECT d, lang, source, unnest(w) AS term FROM texts),
        vocabulary AS (
            SELECT lang, term, count(*) AS n FROM terms GROUP BY ALL HAVING count(DISTINCT d) >= 10),
        languages AS (SELECT lang, count(*)::HUGEINT AS v, sum(n)::HUGEINT AS n FROM vocabulary GROUP BY lang),
        counted AS (SELECT lang, source, term, count(*)::HUGEINT AS n FROM terms JOIN vocabulary USING (lang, term) GROUP BY ALL),
        totals AS (SELECT lang, source, sum(n) AS n FROM counted GROUP BY ALL),
        groups AS (
            SELECT DISTINCT t.lang, t.source, coalesce(totals.n, 0)::HUGEINT AS n, v
            FROM texts t LEFT JOIN totals USING (lang, source) LEFT JOIN languages l ON l.lang = t.lang),
        shares AS MATERIALIZED (
            SELECT g.lang, g.source, term, coalesce(c.n, 0) AS n,
                   (1 + 1000000000 * (coalesce(c.n, 0) + 2) // (g.n + 2 * g.v))::BIGINT AS p,
                   (1 + 1000000000 * (vocabulary.n + 2)::HUGEINT // (l.n + 2 * g.v))::BIGINT AS q
            FROM groups g JOIN vocabulary USING (lang) JOIN languages l USING (lang) LEFT JOIN counted c USING (lang, source, term)),
        sums AS (
            SELECT x.lang, x.source, y.source AS item, sum((x.p - y.p) * (x.p - y.p) // (x.p + y.p))::BIGINT AS value
            FROM shares x JOIN shares y ON x.lang = y.lang AND x.term = y.term AND x.source <> y.source GROUP BY ALL),
        pairs AS (
            SELECT x.lang, x.source, 'pair' AS part, y.source AS item, coalesce(value, 0) AS value
            FROM groups x JOIN groups y ON x.lang = y.lang AND x.source <> y.source
            LEFT JOIN sums ON sums.lang = x.lang AND sums.source = x.source AND sums.item = y.source),
        both_parts AS (
            SELECT * FROM pairs UNION ALL
            SELECT lang, source, 'term', term, (p - q) * (p - q) // (p + q) FROM shares WHERE n > 0 AND p > q)
        SELECT lang, source, part, item, value,
               row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item)::INT AS rank
        FROM both_parts QUALIFY part = 'pair' OR rank <= 10""",
    "op13_centroid_clusters": f"""
        WITH usable AS (
            SELECT row_number() OVER () AS r, vec_id, list_transform(embedding, lambda e: floor(1024 * e::DOUBLE)::BIGINT) AS v
            FROM embeddings
            WHERE len(embedding) = 64 AND len(list_filter(embedding, lambda e: e IS NULL OR NOT isfinite(e))) = 0),
        x AS MATERIALIZED (SELECT r, unnest(range(1, 65)) AS i, unnest(v) AS v FROM usable),
        firsts AS (SELECT r, row_number() OVER (ORDER BY sha256('3:' || vec_id), v) - 1 AS cluster FROM usable),
        c0 AS MATERIALIZED (SELECT cluster, i, v FROM x JOIN firsts USING (r) WHERE cluster < 8),
        {_rounds_sql()},
        sums AS (SELECT cluster, sum(distance)::BIGINT AS cluster_inertia FROM a10 GROUP BY cluster),
        names AS (SELECT cluster, sha256(string_agg(v::VARCHAR, ',' ORDER BY i)) AS centroid_sha256 FROM c10 GROUP BY cluster)
        SELECT vec_id, cluster::INT AS cluster, distance, cluster_inertia, (SELECT sum(cluster_inertia) FROM sums)::BIGINT AS inertia,
               centroid_sha256
        FROM a10 JOIN usable USING (r) JOIN sums USING (cluster) JOIN names USING (cluster)""",
    "op6_line_dedup": """
        WITH texts AS (SELECT doc_id, text, string_split(text, chr(10)) AS l FROM documents),
        places AS (SELECT doc_id, l, unnest(range(1, len(l))) AS i FROM texts),
        windows AS (SELECT doc_id, i, l[i] AS a, l[i + 1] AS b FROM places),
        known AS (SELECT a, b, min(doc_id) AS first FROM windows GROUP BY a, b HAVING count(*) > 1),
        hits AS (SELECT doc_id, i, first, min(i) OVER (PARTITION BY doc_id, a, b) AS least FROM windows JOIN known USING (a, b)),
        gone AS (SELECT doc_id, i FROM hits WHERE doc_id <> first OR i >= least + 2),
        removed AS (SELECT doc_id, i FROM gone UNION SELECT doc_id, i + 1 FROM gone),
        lines AS (SELECT doc_id, unnest(range(1, len(l) + 1)) AS i, unnest(l) AS line FROM texts),
        results AS (
            SELECT doc_id, count(removed.i) AS n_removed, string_agg(line, chr(10) ORDER BY i) FILTER (removed.i IS NULL) AS left_over
            FROM lines LEFT JOIN removed USING (doc_id, i) GROUP BY doc_id)
        SELECT doc_id, coalesce(len(l), 0) AS n_lines, coalesce(n_removed, 0) AS n_removed,
               CASE WHEN text IS NOT NULL THEN sha256(coalesce(left_over, '')) END AS kept_sha256
        FROM texts LEFT JOIN results USING (doc_id)""",
    "op9_chat_formatting": """
        WITH RECURSIVE turns AS (
            SELECT conv_id, turn, role, text, coalesce(length(text) % 24, -1) AS f, turn % 4 < 2 AS searches FROM conversations),
        calls AS (
            SELECT conv_id, turn, CASE WHEN f = 7 THEN turn - 2 ELSE turn END AS name, f, searches, text, role,
                   CASE WHEN f = 4 THEN 'look' WHEN searches THEN 'search' ELSE 'count' END AS tool,
                   CASE WHEN searches THEN 'turn' ELSE 'words' END AS field,
                   (CASE WHEN searches THEN turn ELSE len(string_split(coalesce(text, ''), ' ')) END)::VARCHAR AS number,
                   CASE WHEN f = 6 THEN turn WHEN turn % 8 >= 2 THEN turn - 2 END AS after
            FROM turns WHERE role = 'assistant'),
        bodies AS (
            SELECT *, '{' || concat_ws(',',
                       CASE WHEN searches THEN '"query":' || to_json(coalesce(text, ''))::VARCHAR ELSE '"role":' || to_json(role)::VARCHAR END,
                       CASE WHEN f = 2 THEN '"spare":null' END,
                       CASE WHEN f <> 1 THEN '"' || field || '":' || CASE WHEN f = 0 THEN '"' || number || '"' ELSE number END END) || '}' AS body
            FROM calls),
        waits AS (
            SELECT DISTINCT c.conv_id, c.name, c.after FROM calls c JOIN (SELECT DISTINCT conv_id, name FROM calls) n
            ON n.conv_id IS NOT DISTINCT FROM c.conv_id AND n.name = c.after),
        circles AS (
            SELECT conv_id, name FROM waits WHERE name = after
            UNION SELECT w.conv_id, w.name FROM waits w JOIN circles c ON w.conv_id IS NOT DISTINCT FROM c.conv_id AND w.after = c.name),
        chains AS (
            SELECT DISTINCT conv_id, name, 0 AS level FROM calls c
            WHERE NOT EXISTS (SELECT 1 FROM circles x WHERE x.conv_id IS NOT DISTINCT FROM c.conv_id AND x.name = c.name)
            UNION SELECT w.conv_id, w.name, c.level + 1
            FROM waits w JOIN chains c ON w.conv_id IS NOT DISTINCT FROM c.conv_id AND w.after = c.name
            WHERE NOT EXISTS (SELECT 1 FROM circles x WHERE x.conv_id IS NOT DISTINCT FROM w.conv_id AND x.name = w.name)),
        levels AS (SELECT conv_id, name, max(level) AS level FROM chains GROUP BY ALL),
        answers AS (
            SELECT conv_id, CASE WHEN f = 8 THEN -turn ELSE turn - 1 END AS name, min({'turn': turn, 'text': text}) AS answer
            FROM turns WHERE role <> 'assistant' GROUP BY ALL),
        judged AS (
            SELECT b.*, levels.level, answer,
                   CASE f WHEN 0 THEN field || ' is not integer' WHEN 1 THEN 'missing ' || field WHEN 2 THEN 'unexpected spare'
                          WHEN 3 THEN 'not JSON' WHEN 4 THEN 'unknown tool' WHEN 5 THEN 'not an object' END AS problem,
                   CASE f WHEN 3 THEN NULL WHEN 5 THEN '[' || body || ']' ELSE body END AS arguments
            FROM bodies b
            LEFT JOIN levels ON levels.conv_id IS NOT DISTINCT FROM b.conv_id AND levels.name = b.name
            LEFT JOIN answers ON answers.conv_id IS NOT DISTINCT FROM b.conv_id AND answers.name = b.name)
        SELECT conv_id, 'call_' || name AS call_id, turn AS position, level::INT AS level, problem,
               CASE WHEN level IS NULL THEN 'circular' WHEN problem IS NOT NULL THEN 'invalid' WHEN answer IS NULL THEN 'pending'
                    ELSE 'ok' END AS status,
               '{' || concat_ws(',', '"arguments":' || to_json(arguments)::VARCHAR, '"id":"call_' || name || '"',
                   '"result":' || to_json(answer.text)::VARCHAR, '"tool":"' || tool || '"') || '}' AS json
        FROM judged""",
    "op10_embedding_dedup": """
        WITH RECURSIVE vectors AS (SELECT vec_id, label, embedding::DOUBLE[] AS v FROM embeddings),
        links AS (
            SELECT x.vec_id AS a, y.vec_id AS b
            FROM vectors x JOIN vectors y ON x.label = y.label AND x.vec_id <> y.vec_id
            WHERE list_cosine_similarity(x.v, y.v) >= 0.98),
        counts AS (SELECT a AS vec_id, count(*) AS n FROM links GROUP BY a),
        reached AS (
            SELECT vec_id, vec_id AS other FROM vectors
            UNION SELECT reached.vec_id, links.b FROM reached JOIN links ON links.a = reached.other)
        SELECT vec_id, coalesce(any_value(n), 0) AS n_links, min(other) AS component_id, vec_id = min(other) AS kept
        FROM reached LEFT JOIN counts USING (vec_id) GROUP BY vec_id""",
}
