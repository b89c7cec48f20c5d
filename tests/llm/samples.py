"""Texts and tables that every operator must take."""

import random

ODD = [
    None,
    "",
    " ",
    "\n\n \t",
    "a",
    "A b  c",
    "a B\tc",
    "it's  \n\n we'll do\t x ",
    "　a 　b \xa0 c",
    "\x1c \x1d a \x85 b\x00c",
    "a\n\nb\nc\n",
    ".a,b. c",
    "é. à,b x.   y",
    "▁x a ▁ b▁▁c ▁",
    "👍🏽 x ａｂ é",
    "x" * 70,
    "ab " * 60,
    "<|endoftext|> x",
]


def rows(seed=7, n=40):
    """(doc_id, text): random texts, exact and near copies, a shared passage, repeated rows, equal ids, null ids."""
    rng = random.Random(seed)
    vocabulary = ["".join(rng.choice("abcdeéß") for _ in range(rng.randint(2, 7))) for _ in range(300)]
    text = lambda k: " ".join(rng.choice(vocabulary) + rng.choice(["", "", "", ".", ","]) for _ in range(k))
    out = [(k, text(rng.randint(1, 120))) for k in range(n)]
    passage = text(60)
    for k in range(6):
        out.append((100 + k, f"{text(20)} {passage} {text(rng.randint(0, 30))}\n{passage}"))
    base = text(100).split()
    for k in range(25):
        own = list(base)
        for _ in range(rng.randint(0, 4)):
            own[rng.randrange(len(own))] = f"new{rng.randrange(9999)}"
        out.append((200 + k, " ".join(own)))
    out += [(300 + k, x) for k, x in enumerate(ODD)]
    out += [(3, out[3][1]), (3, out[3][1]), (400, out[5][1]), (401, out[5][1].upper()), (3, out[4][1]), (None, out[6][1]), (None, None)]
    rng.shuffle(out)
    return out


def docs(spark, data=None):
    """A table with further columns, some named like those that operators make."""
    data = rows() if data is None else data
    full = [(i, t, "x", "src0", 1, 0.5, "p", b"d", 1) for i, t in data]
    return spark.createDataFrame(full, "doc_id long, text string, lang string, source string, n_chars long, score double, part string, data binary, set long")


def lowered(text):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
