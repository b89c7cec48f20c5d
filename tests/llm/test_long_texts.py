"""Texts of a million bytes, and texts that sums of powers cannot tell apart."""

import hashlib
import time

import numpy as np
import public_tokenizers
import pytest
import samples

from rotorlake.llm import decontaminate, language, licenses, lines, piece_codec, shingles, suffixes, texts, token_files, toxicity

MODEL = public_tokenizers.path("piece_bpe_32k.model")
TOKENIZER = public_tokenizers.path("byte_bpe_50k.json")


def thue_morse(n, one, other):
    return [one if k.bit_count() % 2 else other for k in range(n)]


#: Two and two texts of equal sums of powers, of letters and of words.
ALIKE = ["".join(thue_morse(2048, "a", "b")), "".join(thue_morse(2048, "b", "a")), " ".join(thue_morse(2048, "yes", "no")), " ".join(thue_morse(2048, "no", "yes"))]
#: A million bytes without blanks; fifty thousand detections; many words.
LONG = ["".join("abcdefgh漢字"[k * k % 10] for k in range(700_000)), "mit license. " * 50_000, "word and more words in a line\n" * 34_000]


def docs(spark, values):
    return samples.docs(spark, list(enumerate(values)))


def test_hashes_tell_alike_texts_apart():
    bounds = np.cumsum([0, *map(len, ALIKE)])
    data = np.frombuffer("".join(ALIKE).encode(), np.uint8)
    assert len(set(texts.hashed(data, bounds[:-1], bounds[1:]).tolist())) == 4
    assert len(set(shingles.sign(bounds, data).tolist())) == 4
    assert len({int(u.digest[k]) for u in lines.units(bounds, data, whole=True)[1:2] for k in range(4)}) == 4


def test_equal_runs_have_equal_hashes_wherever_they_are():
    h = np.random.default_rng(3).integers(0, 1 << 63, 5000).astype(np.uint64)
    h[3000:3500] = h[100:600]
    runs = texts.Sequences(h)
    assert runs.between(np.array([100]), np.array([600])) == runs.between(np.array([3000]), np.array([3500]))
    assert runs.between(np.array([100]), np.array([600])) != runs.between(np.array([3000]), np.array([3501]))
    assert runs.between(np.array([7]), np.array([9])) == texts.Sequences(h[7:9]).between(np.array([0]), np.array([2]))


def test_codecs_equal_their_libraries_on_alike_and_long_texts():
    code, encoder = piece_codec.Codec(MODEL), token_files.Encoder(TOKENIZER)
    import pyarrow as pa

    for group in (ALIKE + ALIKE, LONG, ["▁▁" * 3000, "x▁" * 3000, "é" * 5000, "\x00￿" * 400, "a" * 201]):
        bounds, data = texts.flat(pa.array(group))
        start = time.monotonic()
        ids, counts = code.encode(bounds, data)
        assert [x.tolist() for x in np.split(ids, np.cumsum(counts)[:-1])] == code.library.encode(group)
        assert time.monotonic() - start < 60
        ids, counts = encoder.encode(bounds, data)
        known = encoder.tokenizer.encode_batch(group, add_special_tokens=False)
        assert [x.tolist() for x in np.split(ids, np.cumsum(counts)[:-1])] == [e.ids for e in known]
    assert len(code.memo.keys) < 1 << 20


def test_agenda_equals_rounds():
    code = piece_codec.Codec(MODEL)
    words = [x.replace(" ", "▁") for x in ("▁the", "▁abracadabra", "▁été漢字\x00x", "▁" + "aab" * 60, "▁ⅷ")]
    ids, sizes = code.merged(words)
    assert [code.agenda(w) for w in words] == [x.tolist() for x in np.split(ids, np.cumsum(sizes)[:-1])]


def loop_detect(ordered, text):
    """Every detection against every other one."""
    kept = []
    for rule in ordered:
        if rule.gate in text:
            for m in rule.pattern.finditer(text):
                s, e = m.span()
                if rule.base or not any(a <= s and e <= b and x.priority >= rule.priority for a, b, x in kept):
                    kept = [x for x in kept if x[2].base or x[2].priority > rule.priority or not (s <= x[0] and x[1] <= e)]
                    kept.append((s, e, rule))
    return sorted(((s, e, x.label, x.priority) for s, e, x in kept))


def test_license_sweep_equals_a_loop():
    ordered = licenses.rules()
    scanner = licenses.Scanner(ordered)
    import random

    rng = random.Random(4)
    bits = "gnu general public license|version 2|or any later version|mit license|cc by|cc by sa 4.0|apache license version 2.0|creative commons attribution noncommercial 4.0|lgpl|gpl v3|only|spdx-license-identifier: mit|the|bsd".split("|")
    for _ in range(200):
        text = rng.choice([" ", ", ", "-"]).join(rng.choice(bits) for _ in range(rng.randint(1, 25))).encode()
        got = sorted((s, e, x.label, x.priority) for s, e, x in scanner.detect(text))
        assert got == loop_detect(ordered, text)


@pytest.mark.parametrize("name", ["licenses", "decontaminate", "lines", "shingles", "suffixes", "piece_codec", "language", "toxicity"])
def test_long_texts_come_to_an_end(spark, name):
    df = docs(spark, LONG + ALIKE + ["mit license", "a short one of few words"])
    n = len(LONG) + len(ALIKE) + 2
    if name == "licenses":
        found = {r.doc_id: r for r in licenses.scan(df).collect()}
        assert found[1].n_base == 50_000 and found[1].first_word == 0 and found[1].last_word == 99_998
    elif name == "decontaminate":
        items = spark.createDataFrame([(1, "more words in a line word and more words in a line")], "item_id long, text string")
        found = {r.doc_id: r for r in decontaminate.match(df, items).collect()}
        assert found[2].n_words == 238_000 and list(found[2].items) == ["1"] and len(found[0].items) == 0
    elif name == "lines":
        found = {r.doc_id: r for r in lines.dedup(df, whole=True).collect()}
        assert found[2].kept == "word and more words in a line\n" and found[2].n_removed == 33_999
        assert [found[k].n_removed for k in (3, 4, 5, 6)] == [0, 0, 0, 0]
    elif name == "shingles":
        found = {r.doc_id: r for r in shingles.classes(df).collect()}
        assert [found[k].component_id for k in (3, 4)] == [3, 4]
        words = [set(zip(*[thue_morse(2048, *p)[k : 2048 - 4 + k] for k in range(5)], strict=True)) for p in (("yes", "no"), ("no", "yes"))]
        assert found[5].n_shingles == len(words[0])
    elif name == "suffixes":
        found = {r.doc_id: r for r in suffixes.dedup(docs(spark, ALIKE + [LONG[1][:200_000]])).collect()}
        known = {ALIKE[0][k : k + 50] for k in range(2048 - 49)}
        gone = [False] * 2048
        for k in range(2048 - 49):
            if ALIKE[1][k : k + 50] in known:
                gone[k : k + 50] = [True] * 50
        kept = "".join(c for c, g in zip(ALIKE[1], gone, strict=True) if not g)
        assert found[1].kept_sha256 == hashlib.sha256(kept.encode()).hexdigest()
    elif name == "piece_codec":
        lib = piece_codec.codec(MODEL).library
        found = {r.doc_id: r.n_tokens for r in piece_codec.encode(df, MODEL, with_ids=False).collect()}
        assert found == {k: len(lib.encode(t)) + 1 for k, t in enumerate(LONG + ALIKE + ["mit license", "a short one of few words"])}
    elif name == "language":
        train = samples.docs(spark, [(100 + k, "la casa de la noche") for k in range(20)] + list(enumerate(LONG + ALIKE)))
        assert language.identify(train, toxicity.F.col("doc_id") >= 100, MODEL).count() == n - 2 + 20
    else:
        labels = spark.createDataFrame([(k, k % 2) for k in range(9)], "doc_id long, toxic int")
        model = toxicity.train(df, labels, lambda i: toxicity.F.lit(True))
        assert all(0 <= r.score <= 1 for r in toxicity.scores(df, model).collect())
