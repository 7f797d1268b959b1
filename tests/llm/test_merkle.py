import hashlib

import pytest
from pyspark.sql import functions as F

from larder.llm import merkle

FIELDS = ("doc_id", "source", "lang", "n_chars", "text")


def h(text):
    return hashlib.sha256(text.encode()).hexdigest()


def leaf(row, text):
    values = [row[c] for c in FIELDS[:-1]] + [text]
    return h("".join("-" if v is None else f"{len(str(v).encode())}:{v}" for v in values))


def levels(nodes):
    out = [nodes]
    while len(out[-1]) > 1:
        out.append([h("".join(out[-1][i : i + 3])) for i in range(0, len(out[-1]), 3)])
    return out


def path(tree, i):
    out = []
    for nodes in tree[:-1]:
        run = i // 3 * 3
        out.append(("".join(nodes[run:i]), "".join(nodes[i + 1 : run + 3])))
        i //= 3
    return out


def by_hand(rows, tampered):
    """What manifest() returns, as a sorted list."""
    sources = {}
    for r in rows:
        sources.setdefault(r["source"], []).append(r)
    names = sorted(sources, key=lambda s: (s is not None, (s or "").encode()))
    for s in names:
        sources[s].sort(key=lambda r: (r["doc_id"] is not None, r["doc_id"] or 0, leaf(r, r["text"])))
    trees = {s: levels([leaf(r, r["text"]) for r in sources[s]]) for s in names}
    over = levels([trees[s][-1][0] for s in names])
    root, out = over[-1][0] if rows else None, []
    for k, s in enumerate(names):
        for i, r in enumerate(sources[s]):
            steps = path(trees[s], i) + path(over, k)
            node = leaf(r, tampered(r))
            for left, right in steps:
                node = h(left + node + right)
            out.append((r["doc_id"], trees[s][0][i], trees[s][-1][0], root, h("".join(a + b for a, b in steps)), node, node == root))
    return sorted(out, key=str)


def check(df):
    odd, changed = F.col("doc_id") % 2 == 0, F.replace("text", F.lit("\n"), F.lit(""))
    got = sorted(map(tuple, merkle.manifest(df, odd, changed).collect()), key=str)
    rows = [r.asDict() for r in df.select(*FIELDS).collect()]

    def text(r):
        return r["text"].replace("\n", "") if r["text"] is not None and r["doc_id"] is not None and r["doc_id"] % 2 == 0 else r["text"]

    assert got == by_hand(rows, text)
    return got


@pytest.mark.parametrize("n", [1, 4, 28])
def test_one_source_of_any_size(spark, n):
    df = spark.createDataFrame([(i, "s", "en", 3, f"a\n{i}") for i in range(n)], "doc_id long, source string, lang string, n_chars long, text string")
    assert [r[-1] for r in check(df)].count(False) == (n + 1) // 2  # every even id loses its line feed


def test_messy_rows(messy):
    check(messy)


def test_sources_null_empty_and_beyond_ascii(spark):
    rows = [(i, (None, "", "-", "=", "é", "\U0001f600", "z")[i % 7], None, None, None if i % 5 == 0 else "x\n" * (i % 3)) for i in range(200)]
    check(spark.createDataFrame(rows, "doc_id long, source string, lang string, n_chars long, text string"))


def test_more_than_one_round(spark, monkeypatch):
    """Blocks of nine nodes, so that a hot source climbs over several rounds."""
    monkeypatch.setattr(merkle, "LEVELS", 2)
    rows = [(i, "hot" if i % 3 else f"s{i % 30}", "en", i, f"t\n{i}") for i in range(700)]
    check(spark.createDataFrame(rows, "doc_id long, source string, lang string, n_chars long, text string"))


def test_nothing(nothing):
    assert check(nothing) == []
