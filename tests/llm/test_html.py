import duckdb

from larder.llm import html_blocks as H
from larder.llm import labelled


def test_parts_of_a_page():
    page = """<!DOCTYPE html><html><head><title>T</title><script>var a="</p><p>no";</script></head><body><header><p>Site</p></header>
    <nav><ul><li><a href=/a>Home</a></ul></nav><!-- <p>hidden</p> --><article><h1>Head &amp; more</h1><p>First <b>bold</b>
    <a href='x>y'>link</a>.<br>Next&nbsp;line <p>Second</p><div class="ad">Buy</div><form><p>Name <input></p></form></article>
    <section id="comments"><p>I like it very much and will surely read it again tomorrow morning with all of my many friends</p></section>
    <footer>&copy; me</footer><p"""
    assert H.main_text(page, H.trained()) == "Head & more\n\nFirst bold link. Next line\n\nSecond"


def test_letters_that_lowering_lengthens():
    tree = H.trained()
    for tag in ("script", "style", "iframe", "noscript"):
        page = f"<article><p>\u0130stanbul \u0130zmir</p><{tag}>x('<p>no</p>')</{tag.upper()}><p>after</p></article><p>\u212a</p>"
        assert H.main_text(page, tree).startswith("\u0130stanbul \u0130zmir\n\nafter"), tag
    assert [b.text for b in H.blocks("\u0130<xmp><b>\u0130</xmp>z")] == ["\u0130", "<b>\u0130", "z"]


def test_pages_without_telling_names():
    text = "The harbour office said on monday that two ferries will sail each hour between the island and the town."
    page = f"<div><a href=/>Home</a></div><div>{text}</div><div>{text}</div><div>{text}</div><div><a href=/1>{text}</a></div><div>Imprint</div>"
    assert H.main_text(page, H.trained()) == "\n\n".join([text] * 3)


def test_unclosed_parts():
    tree = H.trained()
    assert H.main_text("<article><p>a</p><script>x", tree) == "a"
    assert H.main_text("<article><p>a</p><!-- x <p>b", tree) == "a"
    assert H.main_text('<article><p>a &am</p><p class="x', tree) == "a &am"
    assert H.main_text("<article>1 < 2 <p>b", tree) == "1 < 2\n\nb"
    assert H.blocks("<li><li>" * 2000 + "x" * 100_000)[0].words == 1


def test_tree_knows_its_examples():
    tree = H.trained()
    pages = [H.blocks(p) for p in labelled.PAGES]
    right = [k == b.marked for p in pages for k, b in zip(H.judge(tree, H.features(p)), p, strict=True)]
    assert sum(right) / len(right) > 0.97


def test_rows(spark):
    rows = [(1, "u", "<article><p>x</p></article>", "e"), (1, "u", "<article><p>x</p></article>", "e"), (2, None, None, "e"), (None, "v", "", None)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string, text string")
    got = sorted(map(tuple, H.extract(pages).collect()), key=str)
    assert got == sorted([(1, "u", "x", 1), (1, "u", "x", 1), (2, None, "", 0), (None, "v", "", 0)], key=str)
    assert H.extract(pages.limit(0)).count() == 0


def test_test_pages(spark):
    """The article elements of the test pages, taken by hand."""
    import html
    import re

    sf = "/root/testdata/sf0.001"
    pages = dict(duckdb.sql(f"SELECT page_id, html FROM '{sf}/pages.parquet'").fetchall())
    for r in H.extract(spark.read.parquet(f"{sf}/pages.parquet")).collect():
        inside = re.search(r"<article>(.*?)(</article|$)", pages[r["page_id"]], re.S)[1]
        plain = [" ".join(html.unescape(re.sub(r"<br>|<[^>]*(>|$)", lambda m: " " if m[0] == "<br>" else "", x)).split()) for x in re.split(r"</?(?:p|h1)>", inside)]
        assert r["text"] == "\n\n".join(x for x in plain if x) and r["n_chars"] == len(r["text"])


def test_quotes_open_values_after_an_equals_sign_alone():
    tree = H.trained()
    for tag in ("<p title=it's>", "<p title=a=\"b>", "<p it's>", "<p a'b=\"c > d\">", "<p title = 'x > y'>", "<p title=>", "<p x='1'y=\"2\">", "<p title=a\"b>"):
        page = f"<article>{tag}First words</p><p>Second <a href=/it's>link</a> don't stop</p></article>"
        assert H.main_text(page, tree) == "First words\n\nSecond link don't stop", tag
    assert H.main_text("<article><p>a</p><p title='x > <b>y", tree) == "a"
    assert H.MARKUP.match("<a " + "x='" * 20_000 + ">")
