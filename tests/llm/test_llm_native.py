"""URL filter, mixing, line dedup, licences and tool calls."""

import hashlib
import json
import math
import random
import textwrap
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from llm import licenses, line_dedup, mixing, tool_calls, url_filter

RULES = {r: v for v, r in url_filter.RULES}
URLS = [
    (1, "http://a.org/x", "a.org", "/x", "org/", "allow"),
    (2, "https://EXAMPLE.org/es/1", "example.org", "/es/1", "example.org/es/", "block"),
    (3, "https://m.example.org/en/12", "m.example.org", "/en/12", "example.org/en/1", "block"),
    (4, "https://example.org/en/21", "example.org", "/en/21", "org/", "allow"),
    (5, "x://example.com/fr/1?q=/de/#t", "example.com", "/fr/1", "com/fr/", "allow"),
    (6, "x://example.com/de/1#t", "example.com", "/de/1", "com/de/", "block"),
    (7, "x://notorg/1", "notorg", "/1", None, None),
    (8, "x://a.org", "a.org", "", None, None),
    (9, "x://a.org?/x", "a.org", "", None, None),
    (10, "no scheme", "", "", None, None),
    (11, None, "", "", None, None),
    (12, "a://b://c/d", "b:", "//c/d", None, None),
    (None, "x://ÄB.net/Ä\n", "Äb.net", "/Ä\n", None, None),
    (1, "http://a.org/x", "a.org", "/x", "org/", "allow"),
]


def test_url_rules(spark):
    df = spark.createDataFrame([(i, u, "z", "z") for i, u, *_ in URLS], "page_id long, url string, host string, rule string")
    got = url_filter.judged_urls(df).collect()
    assert sorted((repr(r.id), r.host, r.path, repr(r.rule)) for r in got) == sorted(
        (repr(i), h, p, repr(rule)) for i, _, h, p, rule, _ in URLS
    )
    assert all(r.verdict == RULES[r.rule] for r in got if r.rule) and all(r.verdict in ("allow", "block") for r in got)
    assert url_filter.judged_urls(df.limit(0)).count() == 0
    assert {r.verdict for r in url_filter.judged_urls(df.where("page_id = 7 OR page_id = 1")).collect()} == {"allow"}


def brute_llr(texts, order):
    """Witten-Bell mixtures by hand: texts (text, allow, block)."""
    seen = {c: [Counter() for _ in range(order + 1)] for c in (1, 2)}
    padded = {t: "\x02" * order + t + "\x03" for t, *_ in texts}
    for row in texts:
        t = padded[row[0]]
        for i in range(order, len(t)):
            for c in (1, 2):
                for k in range(order + 1):
                    seen[c][k][t[i - k : i + 1]] += row[c]
    after = {c: defaultdict(lambda: [0, 0]) for c in (1, 2)}
    for c in (1, 2):
        for counts in seen[c]:
            for gram, n in counts.items():
                after[c][len(gram), gram[:-1]][0] += n
                after[c][len(gram), gram[:-1]][1] += n > 0

    def p(c, gram):
        p = 1 / 256
        for k in range(1, len(gram) + 1):
            n, kinds = after[c][k, gram[-k:-1]]
            if n + kinds:
                p = (seen[c][k - 1][gram[-k:]] + kinds * p) / (n + kinds)
        return p

    def score(t):
        grams = [padded[t][i - order : i + 1] for i in range(order, len(padded[t]))]
        return sum(math.log(p(1, g)) - math.log(p(2, g)) for g in grams) / len(grams)

    return {t: score(t) for t, *_ in texts}


def held_texts(spark, texts):
    frame = spark.createDataFrame([(t,) for t in texts], "text string")
    return {r.text for r in frame.where(url_filter.held_out(F.col("text"))).collect()}


@pytest.mark.parametrize("hot_share", [1 / 2000, 0.02, 2.0])
def test_url_scores_against_brute_force(spark, hot_share):
    df = spark.read.parquet("/root/testdata/sf0.01/pages.parquet")
    got = url_filter.judged_urls(df, hot_share=hot_share).collect()
    texts = defaultdict(lambda: [0, 0])
    for r in got:
        n = texts[r.host + r.path]
        if r.rule:
            n[RULES[r.rule] == "block"] += 1
    held = held_texts(spark, texts)
    wanted = brute_llr([(t, *(n if t not in held else (0, 0))) for t, n in texts.items()], url_filter.ORDER)
    free = [r for r in got if r.rule is None]
    assert free and all(r.score == pytest.approx(wanted[r.host + r.path], abs=1e-5) for r in free)
    allowed = [r.score for r in free if r.verdict == "allow"]
    blocked = [r.score for r in free if r.verdict == "block"]
    assert allowed and blocked and max(blocked) < min(allowed)
    ruled = [(wanted[t], n) for t, n in texts.items() if sum(n) and t in held]
    if not all(sum(n[k] for _, n in ruled) for k in (0, 1)):
        ruled = [(wanted[t], n) for t, n in texts.items() if sum(n)]
    level = (max(blocked) + min(allowed)) / 2

    def wrong(at):
        a, b = (sum(n[k] for _, n in ruled) for k in (0, 1))
        return sum(n[0] for s, n in ruled if s < at) / a + sum(n[1] for s, n in ruled if s >= at) / b

    assert wrong(level) <= min(wrong(k / 64) for k in range(-400, 400)) + 1e-9


def test_whole_urls_are_scored(spark):
    urls = [u for _, u, *_ in URLS] + ["x://free/p?a=1", "x://free/p?b=22", "x://free/p#c", "mailto:someone"]
    df = spark.createDataFrame(list(enumerate(urls)), "page_id long, url string")
    got = {r.id: r for r in url_filter.judged_urls(df, whole=True).collect()}
    texts = defaultdict(lambda: [0, 0])
    for i, r in got.items():
        n = texts[urls[i] or ""]
        if r.rule:
            n[RULES[r.rule] == "block"] += 1
    held = held_texts(spark, texts)
    wanted = brute_llr([(t, *(n if t not in held else (0, 0))) for t, n in texts.items()], url_filter.ORDER)
    free = [r for r in got.values() if r.rule is None]
    assert all(r.score == pytest.approx(wanted[urls[r.id] or ""], abs=1e-5) for r in free)
    assert len({got[i].score for i in range(len(urls) - 4, len(urls))}) == 4
    assert {(r.id, r.host, r.path, r.rule) for r in got.values()} == {
        (r.id, r.host, r.path, r.rule) for r in url_filter.judged_urls(df).collect()
    }


def shares(sizes, weights, most):
    """Shares by pouring: those at their bound stop, the rest take up what is left."""
    target, free, left = {}, set(sizes), float(sum(sizes.values()))
    while free:
        level = left / sum(weights[s] for s in free)
        over = {s for s in free if level * weights[s] > most * sizes[s]}
        if not over:
            return target | {s: level * weights[s] for s in free}
        target |= {s: float(most * sizes[s]) for s in over}
        left -= sum(target[s] for s in over)
        free -= over
    return target


def test_targets_by_pouring(spark):
    rng = random.Random(1)
    for n in (1, 2, 5, 30):
        sizes = {f"s{i:03d}": rng.choice([0, 1, 10, 1000, rng.randrange(10**6)]) for i in range(n)}
        sizes["zz"] = 5
        names = sorted(sizes)
        wanted = shares(sizes, {s: 1 + i % 3 for i, s in enumerate(names)}, 3)
        df = spark.createDataFrame(list(sizes.items()), "source string, size long")
        got = {r.source: r.target for r in mixing.source_targets(df).collect()}
        assert got == pytest.approx(wanted)
        assert sum(got.values()) == pytest.approx(sum(sizes.values()))


def test_mix_takes_its_targets_and_is_the_same_again(spark):
    docs = spark.read.parquet("/root/testdata/sf0.1/documents.parquet")
    rows = mixing.mixed_sizes(docs).collect()
    assert sorted(map(repr, rows)) == sorted(map(repr, mixing.mixed_sizes(docs.repartition(5)).collect()))
    taken, target = Counter(), {}
    for r, s in zip(rows, docs.select("source").collect(), strict=True):
        assert r.taken in (0, r.size, 2 * r.size, 3 * r.size)
        taken[s.source] += r.taken
        target[s.source] = r.target
    assert all(taken[s] == pytest.approx(target[s], rel=0.15) for s in target)
    times = {r.id: r.taken // r.size for r in rows if r.size}
    out = mixing.mixed_documents(docs)
    assert out.columns == docs.columns
    assert {r.doc_id: r.n for r in out.groupBy("doc_id").agg(F.count("*").alias("n")).collect()} == {i: n for i, n in times.items() if n}


def test_mix_odd_rows(spark, odd_docs):
    rows = mixing.mixed_sizes(odd_docs).collect()
    assert len(rows) == 13 and {r.size for r in rows if r.id in (4, 5, 6)} == {0}
    assert {r.source_size for r in rows if r.id in (5,)} == {0} and all(r.taken <= 3 * r.size for r in rows)
    assert mixing.mixed_documents(odd_docs).columns == odd_docs.columns
    clashing = odd_docs.withColumnRenamed("id", "rate").withColumnRenamed("size", "copy")
    assert mixing.mixed_documents(clashing).columns == clashing.columns
    assert mixing.mixed_sizes(odd_docs.limit(0)).count() == mixing.mixed_documents(odd_docs.limit(0)).count() == 0
    unicode = [("\ufffd", 1), ("\U0001f600", 1), (None, 1), ("a", 1)]
    got = mixing.source_targets(spark.createDataFrame(unicode, "source string, size long"), most=9).collect()
    assert {r.source: round(r.target * 7 / 4) for r in got} == {"a": 1, "\ufffd": 2, "\U0001f600": 3, None: 1}


def chunks_of(spark, texts):
    """The chunks of each text as lists of lines, from the places that the operator finds."""
    df = spark.createDataFrame(list(enumerate(texts)), "id long, text string")
    out = {}
    for r in line_dedup.line_chunks(df).collect():
        places = [(s >> 32, s & 0xFFFFFFFF) for s in r._spans]
        assert [a for a, _ in places] == [0, *[a + n for a, n in places]][:-1]
        assert sum(n for _, n in places) == len((texts[r.id] or "").split("\n"))
        out[r.id] = [(a, (texts[r.id] or "").split("\n")[a : a + n]) for a, n in places]
    return out


def test_boundaries_are_local(spark):
    rng = random.Random(2)
    body = [f"line {rng.randrange(10**6)}" for _ in range(200)]
    a, b = chunks_of(spark, ["\n".join(body), "\n".join(["new one", "new two", *body])]).values()
    ends = lambda parts, shift: {at + len(x) - shift for at, x in parts}
    assert ends(a, 0) - ends(b, 2) == set() and len(ends(b, 2) - ends(a, 0)) <= 2
    assert 30 < len(a) < 80


def brute_lines(rows, chunks):
    first = {}
    for k, (i, _) in enumerate(rows):
        for _, lines in chunks[k]:
            if len(lines) > 1 and i is not None:
                first[tuple(lines)] = min(first.get(tuple(lines), i), i)
    out = []
    for k, (i, t) in enumerate(rows):
        seen, stay, gone = set(), [], 0
        for _, lines in chunks[k]:
            key = tuple(lines)
            owner = first.get(key)
            drop = len(lines) > 1 and ((owner is not None and i != owner) or key in seen)
            seen.add(key)
            gone += len(lines) * drop
            stay += [] if drop else lines
        text = None if t is None else "\n".join(stay) if gone else t
        out.append((repr(i), 0 if t is None else len(t.split("\n")), gone, text))
    return sorted(out, key=repr)


def test_lines_against_brute_force(spark):
    rng = random.Random(3)
    blocks = ["\n".join(f"b{k}.{rng.randrange(10**4)}" for _ in range(12)) for k in range(6)]
    rows = [(i, "\n".join(rng.choice([*blocks, f"own {i}", f"x{rng.random()}"]) for _ in range(rng.randrange(9)))) for i in range(40)]
    rows += [(None, blocks[0]), (None, "only\nnull\nids\nhave\nthis\none\nhere"), (7, blocks[1]), (7, blocks[1]), (90, None), (91, "\n\n\n\n\n\n\n\n"), (92, "\n" * 9)]
    rng.shuffle(rows)
    chunks = chunks_of(spark, [t for _, t in rows])
    wanted = brute_lines(rows, chunks)
    assert sum(x[2] for x in wanted) > 100
    df = spark.createDataFrame([(*r, 1) for r in rows], "doc_id long, text string, removed int")
    got = [(repr(r.id), r.n_lines, r.n_removed, r.kept_sha256) for r in line_dedup.line_report(df).collect()]
    assert sorted(got, key=repr) == sorted(
        ((i, n, g, None if t is None else hashlib.sha256(t.encode()).hexdigest()) for i, n, g, t in wanted), key=repr
    )
    out = line_dedup.deduplicated_lines(df)
    assert out.columns == df.columns
    assert sorted((repr(r.doc_id), repr(r.text)) for r in out.collect()) == sorted((i, repr(t)) for i, _, _, t in wanted)
    assert line_dedup.deduplicated_lines(df.limit(0)).count() == 0


def brute_runs(rows):
    """The lines that are in a run of two lines or more which a smaller id has, or their own document before it."""
    gone = [set() for _ in rows]
    for k, (i, t) in enumerate(rows):
        a = (t or "").split("\n")
        for j, (other, u) in enumerate(rows):
            if j != k and (other is None or other == i or (i is not None and other > i)):
                continue
            b = (u or "").split("\n")
            for x in range(len(a)):
                for y in range(len(b)):
                    n = 0
                    while x + n < len(a) and y + n < len(b) and a[x + n] == b[y + n] and (j != k or y + n < x):
                        n += 1
                    if n > 1:
                        gone[k] |= set(range(x, x + n))
    return gone


def test_runs_of_lines_against_brute_force(spark):
    rng = random.Random(5)
    runs = [[f"r{k}.{j}" for j in range(rng.randrange(2, 9))] for k in range(12)]
    rows = []
    for i in range(60):
        parts = [rng.choice([*runs, [f"own {i}.{rng.random()}"], ["one line"]]) for _ in range(rng.randrange(1, 7))]
        rows.append((i, "\n".join(line for part in parts for line in part)))
    rows += [(None, "\n".join(runs[0])), (None, "nulls\nonly"), (None, "nulls\nonly"), (70, None), (71, "a\na\na"), (72, "b\nb\nb\nb")]
    rng.shuffle(rows)
    gone = brute_runs(rows)
    assert sum(map(len, gone)) > 300 and any(len(g) == 2 for g in gone)
    wanted = []
    for (i, t), g in zip(rows, gone, strict=True):
        left = None if t is None else "\n".join(x for n, x in enumerate(t.split("\n")) if n not in g)
        wanted.append((repr(i), len(g), repr(left)))
    df = spark.createDataFrame(rows, "doc_id long, text string")
    out = line_dedup.deduplicated_lines(df, spacing=line_dedup.DENSE).collect()
    assert sorted((repr(r.doc_id), repr(r.text)) for r in out) == sorted((i, t) for i, _, t in wanted)
    report = line_dedup.line_report(df, spacing=line_dedup.DENSE).collect()
    assert sorted((repr(r.id), r.n_removed) for r in report) == sorted((i, n) for i, n, _ in wanted)


def test_odd_rows_have_no_runs(spark, odd_docs):
    assert line_dedup.deduplicated_lines(odd_docs, spacing=line_dedup.DENSE).exceptAll(odd_docs).count() == 0
    assert line_dedup.line_report(odd_docs.limit(0), spacing=line_dedup.DENSE).count() == 0


def test_lines_odd_rows(spark, odd_docs):
    assert line_dedup.deduplicated_lines(odd_docs).exceptAll(odd_docs).count() == 0
    assert line_dedup.line_report(odd_docs).count() == 13


MIT, GPL = "Released under the MIT License.", "This work is licensed under the GNU General Public License, version 3."
FILES = [
    (1, "/p/LICENSE", "Copyright someone\n" + MIT, "MIT", None),
    (2, "/p/a.py", "no notice here", "MIT", "/p"),
    (3, "/p/q/r/b.py", "nothing", "GPL-3.0", "/p/q"),
    (4, "/p/q/COPYING", GPL, "GPL-3.0", None),
    (5, "/p/q/c.py", "x = 1\n# " + MIT, "MIT", None),
    (6, "/p/q/d/e.py", "", "GPL-3.0", "/p/q"),
    (7, "/z/f.py", "some text of the public work", None, None),
    (8, "g.py", None, None, None),
    (9, None, MIT, "MIT", None),
    (10, "/p/q/notice.txt", "nothing", "GPL-3.0", "/p/q"),
    (11, "/m/plain.txt", MIT, "MIT", None),
    (12, "/m/n/o.txt", "text", "MIT", "/m"),
    (2, "/p/a.py", "no notice here", "MIT", "/p"),
    (None, "/p/a2.py", "none", "MIT", "/p"),
    (13, "/", "none", None, None),
]


def test_licences_and_inheritance(spark):
    df = spark.createDataFrame([(i, p, t, "z") for i, p, t, *_ in FILES], "doc_id long, path string, text string, above string")
    got = sorted((repr(r.id), repr(r.path), repr(r.license), repr(r.from_directory)) for r in licenses.scan(df).collect())
    assert got == sorted((repr(i), repr(p), repr(x), repr(d)) for i, p, _, x, d in FILES)
    assert licenses.scan(df.limit(0)).count() == 0


def wrapped(text, mark, width=60):
    """A licence text as a comment of several lines."""
    return "\n".join(f"{mark} {line}" for line in textwrap.wrap(text, width, break_on_hyphens=False))


def test_headers_blocks_and_whole_licence_files(spark):
    """Each template as a header wrapped over several lines in a source file, and as a whole file with a copyright line."""
    flat = [(name, t) for name, texts in licenses.TEMPLATES.items() for t in texts]
    code = "\n\n" + "\n".join(f"def part_{i}(a, b):\n    return a + b * {i}" for i in range(60))
    files = [(f"h{k}", f"/src/{k}/a.py", wrapped(t, "#") + code) for k, (_, t) in enumerate(flat)]
    files += [(f"w{k}", f"/lib/{k}/LICENSE", f"Copyright (c) 2020 Some Body\n\n{wrapped(t, '')}\n") for k, (_, t) in enumerate(flat)]
    files += [(f"i{k}", f"/lib/{k}/deep/b.py", "nothing here") for k in range(len(flat))]
    files += [(f"n{k}", f"/none/{k}.txt", text) for k, text in enumerate([code, "the software is provided and used", "a licence for any purpose without fee"])]
    found = {r.id: r for r in licenses.scan(spark.createDataFrame(files, "doc_id string, path string, text string")).collect()}
    assert len(found) == len(files)
    right = sum(found[f"{kind}{k}"].license == name for kind in "hwi" for k, (name, _) in enumerate(flat))
    # headers of the GNU licences differ by a word or a number, and the short MPL notice is the beginning of the long one
    assert right >= 0.95 * 3 * len(flat)
    assert all(found[f"{kind}{k}"].license is not None for kind in "hwi" for k in range(len(flat)))
    assert all(found[f"i{k}"].from_directory == f"/lib/{k}" for k in range(len(flat)))
    assert all(found[f"n{k}"].license is None for k in range(3))


def test_cosine_by_hand(spark):
    texts = ["Licensed under the Apache License, Version 2.0. Really so, so far.", "apache apache\nthe other", MIT, "none", f"# Released\n# under the\n# MIT License.\n\n{GPL} and more"]
    df = spark.createDataFrame([(k, "/a", t) for k, t in enumerate(texts)], "doc_id long, path string, text string")
    got = {r.id: r.cosine for r in licenses.scan(df, near=0.1).collect()}
    count = Counter(w for t in texts for w in licenses._words(t))
    df_of = {w: sum(w in licenses._words(t) for t in texts) for w in count}

    def vector(t):
        raw = {w: n * (math.log((len(texts) + 1) / (df_of.get(w, 0) + 1)) + 1) for w, n in licenses._words(t).items()}
        norm = math.sqrt(sum(x * x for x in raw.values()))
        return {w: x / norm for w, x in raw.items()} if norm else {}

    for k, t in enumerate(texts):
        best = 0.0
        for unit in [*t.split("\n"), *t.split("\n\n"), t]:
            for v in licenses.TEMPLATES.values():
                for template in v:
                    a, b = vector(unit), vector(template)
                    best = max(best, sum(x * b.get(w, 0) for w, x in a.items()))
        assert got[k] == pytest.approx(best if best >= 0.1 else 0.0, abs=1e-6)


SCHEMAS = {"add": {"a": ("integer", True), "b": ("number", False)}, "say": {"text": ("string", True)}}
CALLS = [
    (1, "c1", 1, "add", '{"b": 1.5, "a": 2}', []),
    (1, "c2", 2, "say", '{"text": "é\\n"}', ["c1"]),
    (1, "c3", 0, "add", '{"a": "x"}', ["c1", "c2", "gone", None]),
    (1, "c4", 4, "add", "not json", None),
    (2, "c5", 5, "fly", "{}", ["c6"]),
    (2, "c6", 6, "say", '{"text": "t", "x": 1}', ["c5"]),
    (2, "c7", 7, "say", "{}", ["c6"]),
    (2, "c8", 8, "say", None, ["c8"]),
    (2, None, 9, "say", '{"text": null}', []),
    (1, "c9", 9, "add", "[1]", ["c3"]),
    (1, "c1", 1, "add", '{"b": 1.5, "a": 2}', []),
]


def test_tool_calls(spark):
    calls = spark.createDataFrame(
        CALLS, "conv_id long, call_id string, position long, tool string, arguments string, after array<string>"
    ).withColumn("level", F.lit("clash"))
    results = spark.createDataFrame(
        [(1, "c1", 5, "late"), (1, "c1", 3, "r1"), (2, "c1", 1, "of another"), (1, "c2", 3, None), (1, "none", 1, "x"), (1, None, 1, "y")],
        "conv_id long, call_id string, position long, content string",
    )
    got = sorted(
        ((r.call_id, r.level, r.status, r.problem, r.json) for r in tool_calls.linked_calls(calls, results, SCHEMAS).collect()), key=repr
    )
    assert len(got) == len(CALLS)
    level = {i: n for i, n, *_ in got}
    assert level == {"c1": 0, "c2": 1, "c3": 2, "c4": 0, "c5": None, "c6": None, "c7": None, "c8": None, None: None, "c9": 3}
    status = {i: s for i, _, s, *_ in got}
    assert status["c1"] == status["c2"] == "ok" and status["c3"] == "invalid" and status["c5"] == "circular"
    problem = {i: p for i, _, _, p, _ in got}
    assert problem == {
        "c1": None, "c2": None, "c3": "a is not integer", "c4": "not JSON", "c5": "unknown tool", "c6": "unexpected x",
        "c7": "missing text", "c8": "not JSON", None: "missing text", "c9": "not an object",
    }
    line = {i: j for i, *_, j in got}
    assert line["c1"] == '{"arguments":"{\\"a\\":2,\\"b\\":1.5}","id":"c1","result":"r1","tool":"add"}'
    assert json.loads(json.loads(line["c2"])["arguments"]) == {"text": "é\n"}
    empty = tool_calls.linked_calls(calls.limit(0), results, SCHEMAS)
    assert empty.count() == 0 and tool_calls.linked_calls(calls, results.limit(0), SCHEMAS).count() == len(CALLS)


def test_one_identifier_in_two_conversations(spark):
    schema = "conv_id long, call_id string, position long, tool string, arguments string, after array<string>"
    rows = [(k, i, p, "say", '{"text": "t"}', w) for k in (1, 2, None) for i, p, w in (("a", 1, ["b"] if k == 2 else []), ("b", 2, ["a"] if k != 2 else []))]
    results = [(k, "a", 3, f"answer of {k}") for k in (1, 2, None)]
    found = tool_calls.linked_calls(
        spark.createDataFrame(rows, schema), spark.createDataFrame(results, "conv_id long, call_id string, position long, content string"), SCHEMAS
    )
    got = {(r.conv_id, r.call_id): (r.level, r.status, json.loads(r.json).get("result")) for r in found.collect()}
    for k in (1, 2, None):
        first, last = ("b", "a") if k == 2 else ("a", "b")
        assert got[k, first][0] == 0 and got[k, last][0] == 1
        assert got[k, "a"][1:] == ("ok", f"answer of {k}") and got[k, "b"][1:] == ("pending", None)


def test_turns_as_calls(spark):
    """Every kind of fault is in the given conversations, and each call is judged as by hand."""
    turns = spark.read.parquet("/root/testdata/sf0.01/conversations.parquet")
    rows = turns.collect()
    found = tool_calls.linked_calls(*tool_calls.turns_as_calls(turns), tool_calls.SCHEMAS).collect()
    got = {(r.conv_id, r.position): r for r in found}
    fault = {(r.conv_id, r.turn): len(r.text) % tool_calls.FAULTS if r.text is not None else -1 for r in rows}
    mine = {(r.conv_id, r.turn): r for r in rows if r.role == "assistant"}
    assert len(found) == len(mine) == len(got)
    name = {k: k[1] - 2 if fault[k] == 7 else k[1] for k in mine}
    waits, answers = {}, {}
    for k in mine:
        after = [k[1]] if fault[k] == 6 else [k[1] - 2] if k[1] % 8 >= 2 else []
        waits.setdefault((k[0], name[k]), set()).update((k[0], t) for t in after)
    for r in rows:
        if r.role != "assistant":
            to = (r.conv_id, -r.turn if fault[r.conv_id, r.turn] == 8 else r.turn - 1)
            answers[to] = min(answers.get(to, (r.turn, r.text)), (r.turn, r.text))
    level, left = {}, {k: {w for w in v if w in waits} for k, v in waits.items()}
    at = 0
    while ready := [k for k, v in left.items() if not v]:
        level.update(dict.fromkeys(ready, at))
        left = {k: v - set(ready) for k, v in left.items() if v}
        at += 1
    problems = set()
    for k, r in mine.items():
        line, key, f = got[k], (k[0], name[k]), fault[k]
        searches, field = k[1] % 4 < 2, "turn" if k[1] % 4 < 2 else "words"
        problem = {
            0: f"{field} is not integer", 1: f"missing {field}", 2: "unexpected spare", 3: "not JSON", 4: "unknown tool", 5: "not an object"
        }.get(f)
        status = "circular" if key not in level else "invalid" if problem else "ok" if key in answers else "pending"
        assert (line.call_id, line.level, line.problem, line.status) == (f"call_{name[k]}", level.get(key), problem, status)
        body = json.loads(line.json)
        assert body.get("result") == (answers[key][1] if key in answers else None)
        if problem is None:
            number = k[1] if searches else len((r.text or "").split(" "))
            expected = {field: number, **({"query": r.text or ""} if searches else {"role": r.role})}
            assert json.loads(body["arguments"]) == expected
            assert body["arguments"] == json.dumps(expected, sort_keys=True, separators=(",", ":"), ensure_ascii=False)
        problems.add(problem or status)
    assert {"not JSON", "unknown tool", "not an object", "unexpected spare", "missing turn", "missing words", "turn is not integer"} <= problems
    assert {"words is not integer", "circular", "ok", "pending"} <= problems and max(level.values()) >= 3
