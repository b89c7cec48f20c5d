"""Top-k search, decontamination and license scan against loops."""

import math
import random
import re

import corpus_pipeline
import numpy as np
import samples
from pyspark.sql import functions as F

from rotorlake.llm import decontaminate, licenses, topk

WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"


def vectors(seed=1, n=400):
    rng = random.Random(seed)
    out = [(k, [rng.gauss(0, 0.2) for _ in range(8)]) for k in range(n)]
    out += [(500 + k, out[k][1]) for k in range(40)] + [(520, out[3][1]), (7, None), (None, out[1][1]), (601, [None] + [0.1] * 7)]
    return out + [(602, [float("nan")] * 8), (603, [float("inf")] + [0.0] * 7), (604, [0.5]), (620, [])]


def test_top_k_equals_all_scores(spark):
    data = vectors()
    df = spark.createDataFrame([(i, v, 1, "x") for i, v in data], "vec_id long, embedding array<double>, score int, cell string")
    got = topk.top_k(df, F.col("vec_id") % 20 == 0, block_rows=16, doc_shard=150, query_shard=10).collect()
    real = [(i, [math.floor(64 * x) for x in v]) for i, v in data if i is not None and v is not None and all(x is not None and math.isfinite(x) for x in v)]
    expected = {}
    for q, a in real:
        if q % 20 == 0:
            own = [(-sum(x * y for x, y in zip(a, b, strict=False)), i) for i, b in real if i != q]
            expected.setdefault(q, []).extend(own)
    rows = set()
    for q, own in expected.items():
        rows |= {(q, k, i, -s) for k, (s, i) in enumerate(sorted(own)[:20], 1)}
    if sum(q == 520 for q, _ in real) == 1:
        assert {tuple(r) for r in got} == rows
    single = {r for r in rows if r[0] != 520}
    assert {tuple(r) for r in got if r[0] != 520} == single


def test_blocks_are_pruned():
    rng = np.random.default_rng(0)
    rows = np.sort(rng.integers(-60, 60, (4000, 4)), axis=0)
    blocks = topk.Blocks(np.arange(4000), rows.astype(float), 50)
    queries = rng.integers(-60, 60, (20, 4)).astype(float)
    *_, scored = topk.search(blocks, np.full(20, -1), queries, 5)
    assert scored < 20 * 80 / 2


def test_top_k_of_nothing(spark):
    df = spark.createDataFrame([], "vec_id long, embedding array<float>")
    assert topk.top_k(df, F.col("vec_id") % 20 == 0).collect() == []


def items(seed=5):
    rng = random.Random(seed)
    data = samples.rows()
    long_ = [t for _, t in data if t and len(t.split()) > 40]
    out = [(k, " ".join(rng.choice(long_).split()[5 : 5 + rng.randint(8, 30)])) for k in range(12)]
    return out + [(20, "a b c"), (21, ""), (22, None), (23, out[0][1]), (None, "x"), (24, "never anywhere at all these words")]


def loop(data, bench, window):
    find = lambda t: re.findall(WORD, samples.lowered(t))
    spots = {}
    for i, t in bench:
        w = find(t)
        for k in range(max(1, len(w) - window + 1) if w else 0):
            spots.setdefault(tuple(w[k : k + window]), set()).add("" if i is None else str(i))
    out = []
    for i, t in data:
        w, hit, names = find(t), set(), set()
        for n in {len(s) for s in spots}:
            for k in range(len(w) - n + 1):
                if (own := spots.get(tuple(w[k : k + n]))) is not None:
                    hit |= set(range(k, k + n))
                    names |= own
        out.append((repr(i), len(w), len(hit), sorted(names)))
    return sorted(out)


def test_decontamination_equals_a_loop(spark):
    data, bench = samples.rows(), items()
    docs = samples.docs(spark, data)
    table = spark.createDataFrame([(i, t, 1) for i, t in bench], "item_id long, text string, hit int")
    expected = loop(data, bench, 10)
    assert sum(x[2] for x in expected) > 100
    for most in (decontaminate.MAX_ITEM_WORDS, 60):
        got = decontaminate.match(docs, table, max_item_words=most)
        got = got.select("doc_id", "n_words", decontaminate.hit_words().alias("n"), "items").collect()
        assert sorted((repr(r[0]), r[1], r[2], r[3]) for r in got) == expected


def test_automaton_equals_all_substrings():
    rng = random.Random(2)
    for _ in range(50):
        sequences = [(str(k), [rng.randrange(3) for _ in range(rng.randint(0, 12))]) for k in range(4)]
        inside = {tuple(s[a:b]) for _, s in sequences for a in range(len(s)) for b in range(a + 1, len(s) + 1)}
        machine = decontaminate.Automaton(sequences, 4)
        stream, state, length = [rng.randrange(4) for _ in range(60)], 0, 0
        for k, w in enumerate(stream):
            state, length = machine.step(state, length, w)
            assert length == max((n for n in range(k + 2) if n == 0 or tuple(stream[k + 1 - n : k + 1]) in inside), default=0)


def test_clean_cuts_passages_and_keeps_the_rest(spark):
    words = [f"w{k}" for k in range(40)]
    bench = spark.createDataFrame([(1, " ".join(words[:15]))], "item_id long, text string")
    data = [(1, "before it, " + " ".join(words[:15]) + " and behind. " + "more " * 30), (2, " ".join(words[:12])), (3, "clean  text\n"), (4, None)]
    docs = samples.docs(spark, data)
    got = decontaminate.clean(docs, bench)
    assert got.columns == docs.columns
    kept = {r.doc_id: r.text for r in got.collect()}
    assert set(kept) == {1, 3, 4} and kept[3] == "clean  text\n" and kept[4] is None
    assert kept[1] == "before it,  and behind. " + "more " * 30


def test_clean_does_not_depend_on_the_number_of_automata(spark):
    docs = samples.docs(spark)
    bench = spark.createDataFrame(items(), "item_id long, text string")
    bench = bench.union(spark.createDataFrame([(k, " ".join(f"w{x}" for x in range(k, k + 12))) for k in range(100, 130)], bench.schema))
    words = [f"w{x}" for x in range(100, 140)]
    odd = [(900, " ".join(words[:30]) + " own" * 35), (901, " ".join(words[3:33]) + " own" * 10), (902, "own " * 40 + " ".join(words[5:18]))]
    docs = docs.union(samples.docs(spark, odd))
    found = []
    for most in (decontaminate.MAX_ITEM_WORDS, 60):
        found.append(sorted(map(repr, decontaminate.clean(docs, bench, max_item_words=most).collect())))
    assert sum(1 for _ in decontaminate.shards(bench, "item_id", "text", 60)) > 5
    assert found[0] == found[1]
    assert not any("doc_id=901," in x for x in found[0]) and sum("doc_id=900," in x for x in found[0]) == 1


def test_clean_cuts_short_items(spark, tmp_path):
    spark.createDataFrame([(1, "What is the capital of France?")], "item_id long, text string").write.parquet(str(tmp_path / "benchmark.parquet"))
    data = [(1, "more " * 30 + "what is the Capital of France? Paris. " + "more " * 30), (2, "what is the capital of " + "more " * 30)]
    got = dict(corpus_pipeline.STAGES)["benchmark_decontamination"](spark, samples.docs(spark, data), str(tmp_path))
    assert {r.doc_id: r.text for r in got.collect()} == {1: "more " * 30 + "? Paris. " + "more " * 30, 2: data[1][1]}


def test_empty_benchmark_and_documents(spark):
    none = spark.createDataFrame([], "item_id long, text string")
    docs = samples.docs(spark)
    assert decontaminate.match(docs, none).where("size(hit) > 0").count() == 0
    assert decontaminate.match(samples.docs(spark, []), none).collect() == []
    assert licenses.scan(samples.docs(spark, [])).collect() == []


def test_license_places_equal_a_loop(spark):
    data = samples.rows() + [
        (700, "Under the GNU General\tPublic, License version 3 or later; GNU general public license."),
        (701, "xgnu general public license, gnu general public licenses, mit-license (MIT) License"),
        (702, "cc by 4.0 cc/by CC-BY-SA 3.0 cc bye Apache License, Version 2.0 all rights reserved"),
    ]
    got = {(repr(r.doc_id), r.n_words): r for r in licenses.scan(samples.docs(spark, data)).collect()}
    for i, t in data:
        w = re.findall(WORD, samples.lowered(t))
        places = [(k, label) for p, label in licenses.BASE.items() for k in range(len(w)) if w[k : k + len(p.split())] == p.split()]
        r = got[(repr(i), len(w))]
        assert (r.n_base, r.first_word, r.last_word) == (len(places), min((k for k, _ in places), default=None), max((k for k, _ in places), default=None))
        assert r.base_labels == ",".join(sorted({x for _, x in places}))
        assert set(r.base_labels.split(",")) <= set(r.labels.split(",")) and 0 <= r.score <= 1
    got = {r.doc_id: r for r in got.values()}
    assert got[702].labels == "apache,apache-2.0,cc-by,cc-by-4.0,cc-by-sa-3.0,proprietary"
    assert "gpl-3-or-later" in got[700].labels


def spelled(tree, wide):
    """A text of a parsed pattern, with all that may be left out or without it."""
    out = ""
    for op, x in tree:
        name = str(op)
        if name == "LITERAL":
            out += chr(x)
        elif name == "IN":
            out += chr(x[0][1] if str(x[0][0]) == "LITERAL" else x[0][1][0])
        elif name in ("MAX_REPEAT", "MIN_REPEAT"):
            out += spelled(x[2], wide) * max(x[0], int(wide))
        elif name == "SUBPATTERN":
            out += spelled(x[3], wide)
        else:
            assert name == "BRANCH"
            out += spelled(x[1][0 if wide else -1], wide)
    return out


def test_every_license_rule_finds_its_spellings():
    for rule in licenses.rules():
        tree = re._parser.parse(rule.source)
        for text in {spelled(tree, wide).replace(" ", gap) for wide in (True, False) for gap in (" ", "-", ", ")}:
            if text.startswith("proprietary") and rule.gate == b"confidential":
                continue  # the word twice is no phrase; its keyword keeps it out
            found = licenses.Scanner([rule]).detect(b"* " + text.encode() + b".")
            assert [(a, b) for a, b, _ in found] == [(2, 2 + len(text))], (rule.source, text)


def test_licenses_without_gaps():
    scan = licenses.Scanner(licenses.rules())
    labels = lambda t: {r.label for _, _, r in scan.detect(t.lower().encode())}
    assert labels("Creative Commons Attribution-NonCommercial-ShareAlike 4.0") == {"cc-by-nc-sa-4.0"}
    assert labels("Creative Commons Attribution-NoDerivatives 4.0") == {"cc-by-nd-4.0"}
    assert labels("Creative Commons Attribution-ShareAlike") == {"cc-by-sa"}
    assert labels("under GPLv3 or LGPL2") == {"gpl-3", "lgpl-2"}
    assert labels("General Public License v2") == {"gpl-2"}
    assert labels("the Beerware license") == {"beerware"}


def test_a_detection_within_another_goes():
    scan = licenses.Scanner(licenses.rules())
    found = scan.detect(b"the mozilla public license 2.0")
    assert [(a, b, r.label) for a, b, r in found] == [(4, 30, "mpl-2.0")]
    assert len(licenses.rules()) > 300
