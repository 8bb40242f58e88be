"""Small documents with every awkward case, and plain versions of shared rules."""

import random

SCHEMA = (
    "doc_id long, text string, lang string, source string, n_chars long, hash string, pos int, bucket int, block "
    "long, score double, text_hash int, part int"
)


def awkward(seed: int = 1) -> list[tuple]:
    rnd = random.Random(seed)
    words = [f"w{i}" for i in range(60)] + ["Der", "É", "ñandú", "x.y", "中文", "!!", "don't"]
    passage = " ".join(rnd.choice(words) for _ in range(40))
    texts = [
        None, "", " \t\n ", "one", "one two", "a b c", "\n\n\n", "x" * 3000, "ÀÉ́ \x1c y", passage, passage,
        passage + " tail", "head " + passage
    ]
    for i in range(30):
        body = [rnd.choice(words) for _ in range(rnd.randint(1, 120))]
        if i % 3 == 0:
            body[len(body) // 2 : len(body) // 2] = passage.split()
        texts.append("\n".join(" ".join(body[k : k + 9]) for k in range(0, len(body), 9)))
    texts.append("\n".join(["common line", " Common LINE\t", "own line"] * 3))
    texts += [f"common line\nown {i}\ncommon line " for i in range(12)]
    texts.append(" ".join(rnd.choice(words) for _ in range(6000)))
    rows = [(k, x, "en", f"s{k % 3}" if k % 7 else None, len(x or "")) for k, x in enumerate(texts)]
    rows += [
        rows[10], rows[10], (None, "no id here", None, "s1", 10), (None, passage, "en", None, 5),
        (None, None, None, None, None)
    ]
    return [(*r, "h", 1, 2, 3, 0.5, 7, 9) for r in rows]


def frame(spark, rows=None):
    return spark.createDataFrame(awkward() if rows is None else rows, SCHEMA).repartition(3)


def empty(spark):
    return spark.createDataFrame([], SCHEMA)


def least_component(nodes, pairs):
    """The least node reachable from each."""
    up = {n: n for n in nodes}

    def find(n):
        while up[n] != n:
            n = up[n]
        return n

    for a, b in pairs:
        a, b = find(a), find(b)
        up[max(a, b)] = min(a, b)
    return {n: find(n) for n in nodes}
