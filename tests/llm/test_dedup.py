"""Substring, line and near-duplicate operators against loops over the same rows."""

import hashlib
import re

import pytest
import samples

from rotorlake.llm import lines, shingles, suffixes

LAST = 2**63 - 1


def ranked(data):
    return [(LAST if i is None else i, t) for i, t in data]


def test_suffixes_equal_a_loop_over_all_strings(spark):
    data = samples.rows() + [(500, "a" * 200), (501, "a" * 120), (502, "z" * 49)]
    got = suffixes.dedup(samples.docs(spark, data)).collect()
    first, size = {}, suffixes.LENGTH
    plain = [(i, (t or "").encode()) for i, t in ranked(data)]
    for i, b in plain:
        for k in range(len(b) - size + 1):
            first[b[k : k + size]] = min(i, first.get(b[k : k + size], LAST))
    expected = []
    for i, b in plain:
        gone = bytearray(len(b))
        for k in range(len(b) - size + 1):
            if first[b[k : k + size]] < i:
                gone[k : k + size] = b"\1" * size
        kept = bytes(x for x, g in zip(b, gone, strict=True) if not g)
        runs = len(re.findall(b"\1+", bytes(gone)))
        expected.append((i, len(b), sum(gone), runs, hashlib.sha256(kept).hexdigest()))
    found = [(LAST if r.doc_id is None else r.doc_id, r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in got]
    assert sorted(found) == sorted(expected)
    assert sum(x[2] for x in expected) > 1000
    for r in got:
        assert hashlib.sha256(r.kept).hexdigest() == r.kept_sha256 and len(r.spans) == 2 * r.n_spans


def test_long_texts_are_looked_at_in_slices(monkeypatch):
    import numpy as np

    data = np.frombuffer(b"".join(b"%d " % (k * k % 991) for k in range(2000)), np.uint8)
    bounds = np.array([0, 37, len(data)])
    whole = suffixes.units(bounds, data, 50)
    monkeypatch.setattr(suffixes, "SLICE", 600)
    sliced = suffixes.units(bounds, data, 50)
    strings = lambda u: {(int(p), int(k)) for _, a, b, k in zip(*u, strict=True) for p in range(a, b + 1)}
    assert strings(whole) == strings(sliced)


def near_duplicates(data):
    """Components by comparing every pair."""
    sets = []
    for _, t in data:
        w = re.findall(r"[^\x20\x09-\x0D]+", samples.lowered(t))
        sets.append({tuple(w[k : k + 5]) for k in range(len(w) - 4)} if len(w) >= 5 else {tuple(w)} if w else set())
    parent = list(range(len(data)))

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a in range(len(data)):
        for b in range(a):
            if sets[a] and sets[b] and 100 * len(sets[a] & sets[b]) >= 80 * len(sets[a] | sets[b]):
                parent[root(a)] = root(b)
    low = {}
    for k, (i, _) in enumerate(data):
        low[root(k)] = min(low.get(root(k), LAST), i)
    return [(i, len(sets[k]), low[root(k)]) for k, (i, _) in enumerate(data)]


def test_shingle_classes_equal_all_pairs(spark):
    data = samples.rows()
    got = shingles.classes(samples.docs(spark, data)).collect()
    none = lambda x: LAST if x is None else x
    assert sorted((none(r.doc_id), r.n_shingles, none(r.component_id)) for r in got) == sorted(near_duplicates(ranked(data)))


def test_walk_equals_sets():
    import random

    rng = random.Random(3)
    for _ in range(200):
        pivot = sorted(rng.sample(range(60), rng.randint(5, 40)))
        members = []
        for k in range(12):
            own = set(pivot) if rng.random() < 0.7 else set(rng.sample(range(60), 20))
            own -= set(rng.sample(range(60), rng.randint(0, 12)))
            if own:
                members.append((k, len(own), sorted(own)))
        expected = [k for k, _, own in members if 100 * len(set(own) & set(pivot)) >= 80 * len(set(own) | set(pivot))]
        assert sorted(shingles.walk(pivot, len(pivot), members)) == expected


def cut_lines(data, least):
    """Kept text of each row, by a loop over units in rank order."""
    split = lambda t: re.findall(r"[^\n]*?(?:\n|[.!?](?=[ \t\n\v\f\r])|$)", t)
    words = lambda u: tuple(re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", samples.lowered(u)))
    plain = [(i, [u for u in split(t or "") if u]) for i, t in ranked(data)]
    first = {}
    for i, own in plain:
        for u in own:
            first[words(u)] = min(i, first.get(words(u), LAST))
    out = []
    for i, own in plain:
        seen, gone = set(), []
        for u in own:
            w = words(u)
            gone.append(len(w) >= least and (first[w] < i or w in seen))
            seen.add(w)
        known = [len(words(u)) >= least for u in own]
        for k in range(len(own)):
            if not known[k]:
                b = next((x for x in range(k, -1, -1) if known[x]), None)
                a = next((x for x in range(k, len(own)) if known[x]), None)
                gone[k] = b is not None and a is not None and gone[b] and gone[a]
        out.append((i, "".join(u for u, g in zip(own, gone, strict=True) if not g)))
    return out


def test_lines_equal_a_loop(spark):
    data = samples.rows()
    data += [(600, "one two three four five six\nshort\none two three four five six"), (601, "x. One  two three, four five six\nshort one\nanother line that is long enough."), (602, "another line THAT is long enough. shorter. one two three four five six")]
    got = lines.dedup(samples.docs(spark, data)).collect()
    expected = cut_lines(data, lines.MIN_WORDS)
    assert sorted((LAST if r.doc_id is None else r.doc_id, r.kept) for r in got) == sorted(expected)
    text = {r.doc_id: r for r in got}
    raw = dict(data)[602].encode()
    assert b"".join(raw[a:b] for a, b in zip(text[602].spans[::2], text[602].spans[1::2], strict=True)) + text[602].kept.encode()
    assert text[602].n_removed >= 2


def test_whole_lines_of_short_sentences_go(spark):
    line, cjk = "Buy now. Call us. It is free. No risk. Act fast.", "这个网站的所有内容都受到版权法的保护"
    data = [(1, f"first text of all here today\n{line}\n{cjk}\n"), (2, f"{line}\nanother one\n{cjk}"), (3, f"one\n{line} {line}\n{line}")]
    data += [(4, "a b c\nd e f\ng h i\n\nother"), (5, "new\n\na b c\nd e f\ng h i\n\nend")]
    docs = samples.docs(spark, data)
    kept = {r.doc_id: r.kept for r in lines.dedup(docs, whole=True).collect()}
    assert kept[1] == data[0][1] and kept[4] == data[3][1]
    assert kept[2] == "another one\n"
    # Two copies in one line are another line; they are the first of their kind.
    assert kept[3] == f"one\n{line} {line}\n"
    assert kept[5] == "new\n\nend"
    assert {r.doc_id: r.text for r in lines.clean(docs, whole=True).collect()} == kept


def test_clean_keeps_rows_and_columns(spark):
    docs = samples.docs(spark)
    for cleaned in (lines.clean(docs), shingles.clean(docs)):
        assert cleaned.columns == docs.columns and cleaned.schema.simpleString() == docs.schema.simpleString()
        assert 0 < cleaned.count() <= docs.count()
    kept = {r.doc_id for r in shingles.clean(docs).collect()}
    assert {i for i, _, c in near_duplicates(ranked(samples.rows())) if i == c and i != LAST} <= kept


def test_one_row_of_each_class_stays(spark):
    words = lambda k, n=60: " ".join(f"w{k}x{x}" for x in range(n))
    near = words(3) + " other"
    data = [(1, words(1)), (2, words(2)), (2, words(1))]  # id 2 has a copy and a text of its own
    data += [(None, words(3)), (None, near), (5, words(4)), (5, words(4)), (5, words(4) + " end"), (None, words(4))]
    data += [(9, ""), (9, ""), (None, None)]
    got = [(r.doc_id, r.text) for r in shingles.clean(samples.docs(spark, data)).collect()]
    count = {x: got.count(x) for x in got}
    assert count.pop((9, "")) == 2 and count.pop((None, None)) == 1
    assert count.pop((1, words(1))) == count.pop((2, words(2))) == 1
    third = [x for x in count if x[0] is None]
    fifth = [x for x in count if x[0] == 5]
    assert len(third) == len(fifth) == 1 and len(count) == 2 and set(count.values()) == {1}


@pytest.mark.parametrize("operator", [suffixes.dedup, shingles.classes, lines.dedup, lines.clean, shingles.clean])
def test_empty_table(spark, operator):
    assert operator(samples.docs(spark, [])).collect() == []
