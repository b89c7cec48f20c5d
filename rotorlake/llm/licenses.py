"""License scan with ordered signature rules.

Rules are regular expressions over a text whose A-Z are lower-cased. Each has a keyword: a rule is tried only where it
occurs. Rules are ordered by priority. Of overlapping detections one that lies within another of the same
or a higher priority is suppressed; base rules (exact phrases) are never suppressed.

Defined results: a null or empty text has no words, places or labels and score 0; repeated rows give repeated
results; texts are scanned whole; columns other than id and text play no part.
"""

from __future__ import annotations

import re
from bisect import bisect_right
from collections.abc import Iterator
from itertools import accumulate, groupby

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rotorlake.llm import texts

#: Between two words of a phrase: anything but word characters.
GAP = rb"(?:[\x00-\x2f\x3a-\x60\x7b-\x7f]+)"
_BEFORE, _AFTER = rb"(?<![0-9a-z\x80-\xff])", rb"(?![0-9a-z\x80-\xff])"

# Base phrases and their labels.
BASE = {
    "gnu general public license": "gpl",
    "apache license": "apache",
    "cc by": "cc-by",
    "mit license": "mit",
}

#: Families with versions: label, name pattern, versions. Every version makes an "or later", an "only" and a plain rule.
VERSIONED = [
    ("gpl", r"(?:gnu )?general public licen[cs]e", "general", ["1", "2", "3"]),
    ("lgpl", r"(?:gnu )?(?:lesser|library) general public licen[cs]e", "general", ["2", "2.1", "3"]),
    ("agpl", r"(?:gnu )?affero general public licen[cs]e", "affero", ["1", "3"]),
    ("gfdl", r"(?:gnu )?free documentation licen[cs]e", "documentation", ["1.1", "1.2", "1.3"]),
    ("apache", r"apache (?:software )?licen[cs]e", "apache", ["1.0", "1.1", "2.0"]),
    ("mpl", r"mozilla public licen[cs]e", "mozilla", ["1.0", "1.1", "2.0"]),
    ("epl", r"eclipse public licen[cs]e", "eclipse", ["1.0", "2.0"]),
    ("cddl", r"common development and distribution licen[cs]e", "development", ["1.0", "1.1"]),
    ("cpl", r"common public licen[cs]e", "common", ["1.0"]),
    ("eupl", r"european union public licen[cs]e", "european", ["1.0", "1.1", "1.2"]),
    ("osl", r"open software licen[cs]e", "open", ["1.0", "2.0", "2.1", "3.0"]),
    ("afl", r"academic free licen[cs]e", "academic", ["1.2", "2.0", "2.1", "3.0"]),
    ("artistic", r"artistic licen[cs]e", "artistic", ["1.0", "2.0"]),
    ("ofl", r"(?:sil )?open font licen[cs]e", "font", ["1.0", "1.1"]),
    ("lppl", r"latex project public licen[cs]e", "latex", ["1.0", "1.1", "1.2", "1.3"]),
    ("zpl", r"zope public licen[cs]e", "zope", ["1.1", "2.0", "2.1"]),
    ("bsl", r"boost software licen[cs]e", "boost", ["1.0"]),
    ("ecl", r"educational community licen[cs]e", "educational", ["1.0", "2.0"]),
    ("cecill", r"cecill(?: free software licen[cs]e)?", "cecill", ["1.0", "1.1", "2.0", "2.1"]),
    ("odbl", r"open (?:data commons )?database licen[cs]e", "database", ["1.0"]),
]
#: Creative Commons: every attribution kind in every version.
CC_KINDS = {
    "by": r"attribution",
    "by-sa": r"attribution share ?alike",
    "by-nd": r"attribution no ?deriv(?:ative)?s?",
    "by-nc": r"attribution non ?commercial",
    "by-nc-sa": r"attribution non ?commercial share ?alike",
    "by-nc-nd": r"attribution non ?commercial no ?deriv(?:ative)?s?",
}
CC_VERSIONS = ["1.0", "2.0", "2.5", "3.0", "4.0"]
#: Rules without versions: label, pattern, score.
PLAIN = [
    ("mit", r"permission is hereby granted free of charge to any person obtaining a copy", "permission", 1.0),
    ("mit", r"(?:expat|x11) licen[cs]e", "licen", 0.9),
    ("mit", r"(?:licensed|released|distributed) under (?:the )?(?:terms of the )?mit", "mit", 0.95),
    ("bsd", r"redistribution and use in source and binary forms with or without modification", "redistribution", 1.0),
    ("bsd", r"(?:0|zero|2|two|3|three|4|four) clause bsd", "bsd", 0.95),
    ("bsd", r"(?:new|revised|simplified|modified) bsd licen[cs]e", "bsd", 0.95),
    ("bsd", r"bsd licen[cs]es?", "bsd", 0.9),
    ("isc", r"permission to use copy modify and or distribute this software for any purpose", "permission", 1.0),
    ("isc", r"isc licen[cs]e", "isc", 0.9),
    ("zlib", r"(?:zlib|libpng)(?: libpng)? licen[cs]e", "lib", 0.9),
    ("unlicense", r"this is free and unencumbered software released into the public domain", "unencumbered", 1.0),
    ("unlicense", r"(?:the )?unlicense", "unlicense", 0.8),
    ("wtfpl", r"do what the fuck you want to public licen[cs]e", "fuck", 0.95),
    ("wtfpl", r"wtfpl", "wtfpl", 0.95),
    ("public-domain", r"(?:released|dedicated|placed)(?: in| into| to)* the public domain", "public", 0.8),
    ("public-domain", r"public domain", "public", 0.5),
    ("cc0", r"cc0", "cc0", 0.9),
    ("cc0", r"creative commons zero", "commons", 0.9),
    ("psf", r"python software foundation licen[cs]e", "python", 0.9),
    ("php", r"php licen[cs]e", "php", 0.9),
    ("ruby", r"ruby licen[cs]e", "ruby", 0.8),
    ("openssl", r"openssl licen[cs]e", "openssl", 0.9),
    ("ms-pl", r"microsoft public licen[cs]e", "microsoft", 0.9),
    ("ms-rl", r"microsoft reciprocal licen[cs]e", "microsoft", 0.9),
    ("ncsa", r"(?:university of illinois )?ncsa open source licen[cs]e", "ncsa", 0.9),
    ("vim", r"vim licen[cs]e", "vim", 0.8),
    ("beerware", r"beer ?ware licen[cs]e", "beer", 0.9),
    ("sspl", r"server side public licen[cs]e", "server", 0.95),
    ("busl", r"business source licen[cs]e", "business", 0.95),
    ("elastic", r"elastic licen[cs]e", "elastic", 0.9),
    ("proprietary", r"all rights reserved", "rights", 0.6),
    ("proprietary", r"(?:proprietary|confidential) and (?:proprietary|confidential)", "confidential", 0.7),
    ("proprietary", r"unauthori[sz]ed (?:copying|use|reproduction|distribution)", "unauthori", 0.6),
    ("copyright", r"copyright (?:c )?(?:19|20)[0-9][0-9]", "copyright", 0.5),
]

# Priorities: larger wins.
P_BASE, P_TEXT, P_VERSION, P_NAME, P_SPDX = 50, 40, 30, 20, 10


class Rule:
    """One signature: pattern and its source, label, priority, score and the keyword that gates it."""

    __slots__ = ("pattern", "source", "label", "priority", "score", "gate", "base")

    def __init__(self, pattern: str, label: str, priority: int, score: float, gate: str, base: bool = False) -> None:
        body = b"".join(GAP if c == " " else c.encode() for c in pattern)
        self.pattern = re.compile(_BEFORE + rb"(?:" + body + rb")" + _AFTER)
        self.source = pattern
        self.label, self.priority, self.score, self.base = label, priority, score, base
        self.gate = gate.encode()


def rules() -> list[Rule]:
    """All rules, highest priority first."""
    made = [Rule(phrase, label, P_BASE, 1.0, phrase.split()[0], base=True) for phrase, label in BASE.items()]
    later = r"(?: of the license)? or (?:at your option )?(?:any )?later(?: version)?"
    for label, name, gate, versions in VERSIONED:
        made.append(Rule(name, label, P_NAME, 0.9, gate))
        for v in versions:
            number = v.replace(".", " ")  # words hold no full stop
            tail = rf"(?: as published by the free software foundation)?(?: either)?(?: v| version)? ?{number}(?: 0)?"
            made.append(Rule(rf"{name}{tail}{later}", f"{label}-{v}-or-later", P_TEXT, 1.0, gate))
            made.append(Rule(rf"{name}{tail} only", f"{label}-{v}-only", P_TEXT, 1.0, gate))
            made.append(Rule(rf"{name}{tail}", f"{label}-{v}", P_VERSION, 0.95, gate))
            made.append(Rule(rf"{label} ?v?{number}", f"{label}-{v}", P_SPDX, 0.9, label))
    for kind, name in CC_KINDS.items():
        spaced = kind.replace("-", " ")
        made.append(Rule(rf"creative commons {name}", f"cc-{kind}", P_NAME, 0.9, "commons"))
        if kind != "by":
            made.append(Rule(rf"cc {spaced}", f"cc-{kind}", P_NAME, 0.9, "cc"))
        for v in CC_VERSIONS:
            number = v.replace(".", " ")
            made.append(Rule(rf"creative commons {name}(?: v?)?{number}", f"cc-{kind}-{v}", P_VERSION, 0.95, "commons"))
            made.append(Rule(rf"cc {spaced} {number}", f"cc-{kind}-{v}", P_VERSION, 0.95, "cc"))
            made.append(Rule(rf"creativecommons org licenses {spaced} {number}", f"cc-{kind}-{v}", P_TEXT, 1.0, "creativecommons"))
    made += [Rule(p, label, P_TEXT if score == 1.0 else P_NAME, score, gate) for label, p, gate, score in PLAIN]
    made.append(Rule(r"spdx license identifier [0-9a-z]+", "spdx", P_SPDX, 0.9, "spdx"))
    return sorted(made, key=lambda r: -r.priority)


class Scanner:
    """Tries the rules on texts; only rules whose keyword occurs are tried."""

    def __init__(self, ordered: list[Rule]) -> None:
        self.by_gate: dict[bytes, list[tuple[int, Rule]]] = {}
        for k, rule in enumerate(ordered):
            self.by_gate.setdefault(rule.gate, []).append((k, rule))

    def detect(self, text: bytes) -> list[tuple[int, int, Rule]]:
        """Detections that stay, by place; ``text`` is lower-cased."""
        tried = sorted((x for gate, own in self.by_gate.items() if gate in text for x in own), key=lambda x: x[0])
        kept: list[tuple[int, int, Rule]] = []
        for _, level in groupby(tried, lambda x: x[1].priority):
            found = [(*m.span(), k, rule) for k, rule in level for m in rule.pattern.finditer(text)]
            # What holds a detection starts no later, so in this order it comes before it.
            found.sort(key=lambda x: (x[0], -x[1], not x[3].base, x[2]))
            kept.sort(key=lambda x: x[0])
            starts = [x[0] for x in kept]
            reach = list(accumulate((x[1] for x in kept), max))
            most = -1
            for s, e, _, rule in found:
                at = bisect_right(starts, s)
                if rule.base or (most < e and (not at or reach[at - 1] < e)):
                    kept.append((s, e, rule))
                most = max(most, e)
        return sorted(kept, key=lambda x: (x[0], -x[1], -x[2].priority, x[2].label))


SCHEMA = (
    "doc_id {id}, n_words long, n_base long, first_word long, last_word long, base_labels string, labels string, "
    "score double, spans array<struct<start:long,end:long,label:string>>"
)


def scan(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per document: words, places of base phrases, labels, score and all detections as byte spans."""
    source = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"))
    schema = SCHEMA.format(id=source.schema["doc_id"].dataType.simpleString())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scanner = Scanner(rules())
        span = pa.struct([("start", pa.int64()), ("end", pa.int64()), ("label", pa.string())])
        for batch, bounds, data in texts.pieces(batches, "text"):
            low = texts.lower(data)
            starts, _ = texts.words(bounds, data, texts.ALNUM)
            first = np.searchsorted(starts, bounds)
            whole, out = low.tobytes(), []
            for r in range(batch.num_rows):
                a, b = int(bounds[r]), int(bounds[r + 1])
                found = scanner.detect(whole[a:b])
                base = [x for x in found if x[2].base]
                places = np.searchsorted(starts[first[r] : first[r + 1]], [a + x[0] for x in base]).tolist()
                out.append(
                    (
                        int(first[r + 1] - first[r]),
                        len(base),
                        min(places, default=None),
                        max(places, default=None),
                        ",".join(sorted({x[2].label for x in base})),
                        ",".join(sorted({x[2].label for x in found})),
                        max((x[2].score for x in found), default=0.0),
                        [{"start": s, "end": e, "label": x.label} for s, e, x in found],
                    )
                )
            kinds = [pa.int64()] * 4 + [pa.string()] * 2 + [pa.float64(), pa.list_(span)]
            columns = [pa.array(x, k) for x, k in zip(zip(*out, strict=True), kinds, strict=True)]
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), *columns],
                names=["doc_id", "n_words", "n_base", "first_word", "last_word", "base_labels", "labels", "score", "spans"],
            )

    return source.mapInArrow(run, schema)
