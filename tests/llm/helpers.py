"""Small documents with the cases that every operator must bear."""

import random

SCHEMA = ("doc_id long, text string, lang string, source string, n_chars long,"
          " kept string, n_tokens string, id string, clean_text string")


def prose(seed: int, words: int = 60) -> str:
    r = random.Random(seed)
    stems = "an be the of ner tion ha re ou and thes ing".split()
    out = ["".join(r.choice(stems) for _ in range(r.randint(1, 3))) for _ in range(words)]
    lines = [" ".join(out[k:k + 15]).capitalize() + "." for k in range(0, words, 15)]
    return "\n".join(lines)


def rows():
    base, other = prose(1), prose(2)
    near = base.replace(base.split()[20], "changed", 1)
    texts = [(1, base), (2, other), (3, base), (4, near), (5, None), (6, ""), (7, " \n\t "),
             (8, "one two"), (9, "ONE two"), (10, "a" * 3000 + " " + prose(3, 3000)),
             (11, other + "\n" + base), (None, prose(4)), (None, base), (12, "x y z\x00w ünï 😀"),
             (13, prose(5)), (13, prose(5)), (14, "same same " * 40)]
    return [(i, t, None, None if i == 2 else "s", None, "k", None, "i", "c") for i, t in texts]


def frame(spark, data=None):
    return spark.createDataFrame(rows() if data is None else data, SCHEMA)


def docs(spark, pairs):
    return spark.createDataFrame(list(pairs), "doc_id long, text string")
