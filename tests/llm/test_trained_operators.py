import random

import numpy as np
import pytest

from larder.llm import decontaminate as B
from larder.llm import language as L

SF = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def documents(spark):
    return spark.read.parquet(f"{SF}/documents.parquet")


@pytest.fixture(scope="module")
def model(documents):
    return L.train(documents)


# ---- language ------------------------------------------------------------

def test_held_out_accuracy(spark, documents, model):
    got = L.predict(documents, model).join(documents.select("doc_id", "lang"), "doc_id").filter("held_out AND lang IS NOT NULL")
    assert got.filter("lang_pred = lang").count() / got.count() > 0.98
    assert got.filter("NOT accepted").count() <= 0.005 * got.count()


def test_held_out_fold_is_never_learnt(spark, documents, model):
    from pyspark.sql import functions as F

    changed = documents.withColumn("lang", F.when(L.held_out(F.col("doc_id")), "zz").otherwise(F.col("lang")))
    again = L.train(changed)
    assert again.languages == model.languages and np.array_equal(again.table, model.table)


def test_logits_by_plain_loops(model):
    text = "Ça va, the Bird über 1 é!".encode()
    rows = [r for part in L.subwords(np.frombuffer(text, np.uint8)) for r in part]
    want = model.table[rows].mean(0) + model.bias
    both = np.frombuffer(text + b"x" + text, np.uint8)
    got = model.logits(both, np.array([0, len(text), len(text) + 1, len(both), len(both)]))
    assert np.allclose(got[0], want, atol=1e-5) and np.allclose(got[2], want, atol=1e-5) and np.allclose(got[3], model.bias)


def test_messy_rows(messy, nothing, model):
    got = {(r["doc_id"], r["lang_pred"] == "und", r["score"] == 0) for r in L.predict(messy, model).collect()}
    assert all(und == zero for _, und, zero in got)
    assert {i for i, und, _ in got if und} == {1, 2, 3, 10, None}
    assert L.accepted(messy, model).columns == messy.columns
    assert L.predict(nothing, model).count() == 0 == L.accepted(nothing, None).count()
    assert L.train(nothing) is None
    assert {r["lang_pred"] for r in L.predict(messy, None).collect()} == {"und"}


def test_one_language(make):
    docs = make([(i, f"some words {i}", "en") for i in range(30)])
    assert {r["lang_pred"] for r in L.predict(docs, L.train(docs)).collect()} == {"en"}


def test_rejection_is_calibrated(model):
    assert 0 <= model.limit <= L.REJECT_MOST and 0.2 < model.temperature < 5


OTHERS = {
    "pl": "Wszyscy ludzie rodzą się wolni i równi w swojej godności i prawach. Są oni obdarzeni rozumem i sumieniem i powinni postępować wobec innych w duchu braterstwa.",
    "fi": "Kaikki ihmiset syntyvät vapaina ja tasavertaisina arvoltaan ja oikeuksiltaan. Heille on annettu järki ja omatunto, ja heidän on toimittava toisiaan kohtaan veljeyden hengessä.",
    "tr": "Bütün insanlar hür, haysiyet ve haklar bakımından eşit doğarlar. Akıl ve vicdana sahiptirler ve birbirlerine karşı kardeşlik zihniyeti ile hareket etmelidirler.",
    "ru": "Все люди рождаются свободными и равными в своем достоинстве и правах. Они наделены разумом и совестью.",
    "zh": "人人生而自由，在尊严和权利上一律平等。他们赋有理性和良心，并应以兄弟关系的精神相对待。",
    "markup": '<div class="x1"><span id="a3"><a href="/p?q=1&r=2"><td></td></a></span></div>' * 6,
}


def letters(seed):
    rng = random.Random(seed)
    return " ".join("".join(rng.choice("abcdefghijklmnopqrstuvwxyz") for _ in range(rng.randint(2, 9))) for _ in range(40))


@pytest.mark.parametrize("learnt", [("de", "en", "es", "fr"), ("de", "en", "fr"), ("en", "fr")])
def test_unlearned_languages_and_gibberish_go(documents, make, learnt):
    known = documents.filter(documents["lang"].isin(*learnt))
    model = L.train(known)
    texts = [*OTHERS.values(), *(letters(k) for k in range(20))]
    rows = make([(i, t, None) for i, t in enumerate(texts)])
    assert L.accepted(rows, model).count() == 0
    assert {r["accepted"] for r in L.predict(rows, model).collect()} == {False}
    clean = known.filter(L.held_out(known["doc_id"]))
    assert L.accepted(clean, model).count() >= 0.99 * clean.count()


# ---- benchmark -----------------------------------------------------------

def brute_tiles(x, y, least):
    """Greedy string tiling by its definition."""
    mx, my, total = [False] * len(x), [False] * len(y), []
    while True:
        best, found = least, []
        for i in range(len(x)):
            for j in range(len(y)):
                k = 0
                while i + k < len(x) and j + k < len(y) and x[i + k] == y[j + k] and not mx[i + k] and not my[j + k]:
                    k += 1
                if k > best:
                    best, found = k, []
                if k == best:
                    found.append((i, j))
        if not found:
            return sum(total)
        for i, j in found:
            if not any(mx[i : i + best]) and not any(my[j : j + best]):
                mx[i : i + best] = my[j : j + best] = [True] * best
                total.append(best)


def test_tiles_cover_what_the_definition_covers():
    rng = random.Random(4)
    for _ in range(40):
        y = [rng.randrange(30) for _ in range(rng.randint(5, 30))]
        cut = sorted(rng.sample(range(len(y)), 2))
        pieces = [y[: cut[0]], y[cut[0] : cut[1]], y[cut[1] :]]
        rng.shuffle(pieces)
        x = [rng.randrange(30) for _ in range(8)] + sum(([*p, 99] for p in pieces), [])
        ax, ay = (np.array(v, np.uint64) * np.uint64(0x9E3779B97F4A7C15) for v in (x, y))
        tiles = B.tile(ax, ay, 3)
        assert all(x[a : a + n] == y[b : b + n] for a, b, n in tiles)
        assert sum(n for *_, n in tiles) == brute_tiles(x, y, 3)


@pytest.fixture(scope="module")
def benchmark(spark):
    rng = random.Random(9)
    items = [" ".join(f"w{rng.randrange(400)}" for _ in range(40)) for _ in range(12)] + ["tiny item", "", None]
    return items, spark.createDataFrame(list(enumerate(items)), "item_id long, text string")


def test_finds_reordered_passages(make, benchmark, nothing, messy):
    items, table = benchmark
    w = items[3].split()
    rows = [
        (1, "intro words here " + items[0] + " outro", "en"), (2, " ".join(w[20:] + ["between"] + w[:20]), "en"), (3, items[1].upper().replace(" ", ", "), "en"),
        (4, " ".join(items[2].split()[:15]), "en"), (5, "nothing of it", "en"), (6, " ".join(reversed(items[4].split())), "en"), (7, None, "en"), (8, "", None),
        (9, "a tiny item here", "en"), (1, "other text", "en"), (None, items[5], "en"),
    ]
    for size in (1 << 22, 30):
        got = {r["doc_id"]: (r["items"], round(r["coverage"], 3)) for r in B.contaminated(make(rows), table, block_tokens=size).collect()}
        assert got == {1: ("0", 1.0), 2: ("3", 1.0), 3: ("1", 1.0), 9: ("12", 1.0), None: ("5", 1.0)}
        kept = B.clean(make(rows), table, block_tokens=size)
        assert sorted((r["doc_id"], r["text"] or "") for r in kept.collect()) == sorted((i, t or "") for i, t, _ in rows if i in (4, 5, 6, 7, 8) or t == "other text")
        assert kept.columns == make(rows).columns
    assert B.contaminated(nothing, table).count() == 0 == B.contaminated(make(rows), table.limit(0)).count()
    assert B.clean(messy, table).count() == messy.count()


def test_test_documents(spark, documents):
    table = spark.read.parquet(f"{SF}/benchmark.parquet")
    items = [r["text"] for r in table.collect()]
    planted = {r["doc_id"] for r in documents.collect() if any(t in (r["text"] or "") for t in items)}
    got = {r["doc_id"] for r in B.contaminated(documents, table).collect()}
    assert planted <= got and len(got - planted) <= 2
