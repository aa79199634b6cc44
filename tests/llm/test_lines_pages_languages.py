"""Line hashing, winnowing, site templates and language identification."""

from __future__ import annotations

import random
import re

from odd import words

from shotmarts.llm import languages, repeated_lines, templates, winnowing

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def first_lines_only(rows, min_words):
    """Clean texts when each long line stays at its first place."""
    seen, clean = set(), {}
    for doc_id, text in sorted((r for r in rows if r[0] is not None), key=lambda r: r[0]):
        kept = []
        for line in (text or "").split("\n"):
            key = tuple(w.encode().lower() for w in WORD.findall(line))
            if len(key) < min_words or key not in seen:
                kept.append(line)
            if len(key) >= min_words:
                seen.add(key)
        clean[doc_id] = text and "\n".join(kept)
    return clean


def line_corpus(seed):
    rng = random.Random(seed)
    lines = [" ".join(words(rng, rng.choice([3, 25, 40]), 10**6)) for _ in range(40)]
    return [(i, "\n".join(rng.choice(lines) for _ in range(rng.randrange(1, 8)))) for i in range(80)]


def test_line_hashing(spark):
    rows = line_corpus(1)
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    got = repeated_lines.remove(docs).collect()
    assert {r.doc_id: r.clean_text for r in got} == first_lines_only(rows, 20)
    texts = dict(rows)
    for r in got:
        for start, end, keep_id in r.removed:
            assert texts[r.doc_id][start:end] in texts[keep_id].split("\n") and keep_id <= r.doc_id


def test_passages_of_short_lines(spark):
    rng = random.Random(3)
    line = lambda n: " ".join(words(rng, n, 10**6))
    six, mixed, alone = [line(12) for _ in range(6)], [line(30), line(4), line(30)], line(12)
    rows = [
        (1, "\n".join([line(7), *six, line(7), *mixed, line(9), alone])),
        (2, "\n".join([line(5), *six[:3], "", *six[3:], alone.upper(), line(8)])),
        (3, "\n".join([alone, line(5), *mixed, line(6)])),
        (4, "\n".join([alone, line(6), six[0], line(7), mixed[1]])),
        (5, "\n".join([six[4], six[1], line(6)])),
    ]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    got = {r.doc_id: r for r in repeated_lines.remove(docs).collect()}
    lines = {d: text.split("\n") for d, text in rows}
    assert got[1].n_removed == got[4].n_removed == 0
    assert got[2].clean_text.split("\n") == [lines[2][0], "", lines[2][-1]]
    assert got[3].clean_text.split("\n") == [*lines[3][:2], lines[3][-1]]
    assert got[5].clean_text == lines[5][-1]
    for r in got.values():
        for start, end, keep_id in r.removed:
            assert dict(rows)[r.doc_id][start:end].lower() in [x.lower() for x in lines[keep_id]]


def test_passages_inside_lines(spark):
    """Passages of 51 words or more that begin and end inside lines leave the later documents only."""
    rng = random.Random(4)
    text = lambda n: words(rng, n, 10**6)
    passages = [text(rng.randrange(51, 90)) for _ in range(30)]
    rows, plain = [], []
    for i, passage in enumerate(passages):
        for doc_id in (i, 100 + i):
            whole = text(30) + [x.upper() if doc_id == i else x for x in passage] + text(30)
            if i % 2:  # a line break at the same place of the passage
                whole[70] += "\n" + whole.pop(71)
            rows.append((doc_id, " ".join(whole)))
            plain.append((doc_id, whole))
    rows.append((200, " ".join(text(200) + passages[0][:19] + text(200))))
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    got = {r.doc_id: r for r in repeated_lines.remove(docs).collect()}
    texts = dict(rows)
    assert not any(got[d].n_removed for d in [*range(30), 200])
    for i, passage in enumerate(passages):
        r, known = got[100 + i], {x.lower() for x in passage}
        assert r.n_removed >= 1
        gone = [x for start, end, keep_id in r.removed for x in texts[100 + i][start:end].split()]
        assert len(gone) >= 20 and set(gone) <= known and {x.keep_id for x in r.removed} == {i}
        assert sorted(gone + r.clean_text.split()) == sorted(texts[100 + i].split())
        assert ("\n" in r.clean_text) == ("\n" in texts[100 + i])


def test_paragraphs(spark):
    part = "\n".join(" ".join(f"p{i}{k}" for k in range(12)) for i in range(3))
    rows = [(1, f"head\n\n{part}"), (2, f"{part.upper()}\n \nother"), (3, None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = {r.doc_id: r for r in repeated_lines.remove(docs, "paragraph").collect()}
    assert got[1].n_removed == got[3].n_removed == 0 and got[3].clean_text is None
    assert got[2].n_removed == 1 and got[2].clean_text.strip() == "other"


def test_line_operators_odd_rows(odd_docs, no_docs):
    for remove in (repeated_lines.remove, winnowing.remove):
        got = remove(odd_docs).collect()
        assert len(got) == odd_docs.count()
        long_line = next(r.text for r in odd_docs.collect() if r.doc_id == 5)
        if remove is repeated_lines.remove:
            assert sum(long_line in (r.clean_text or "") for r in got) == 1
        assert remove(no_docs).count() == 0


def test_winnowing_guarantee():
    rng = random.Random(6)
    for _ in range(200):
        shared = [rng.randrange(100) for _ in range(3)]
        one = [rng.randrange(100) for _ in range(rng.randrange(6))] + shared
        two = shared + [rng.randrange(100) for _ in range(rng.randrange(6))]
        prints = [{h for h, _ in winnowing.winnow(x, 2, 2)} for x in (one, two)]
        assert prints[0] & prints[1]


def test_winnowed_runs(spark):
    rng = random.Random(7)
    line = lambda: " ".join(words(rng, 10, 10**6))
    passage, other = [line() for _ in range(5)], [line() for _ in range(4)]
    rows = [
        (1, "\n".join([line(), *passage[:3], line()])),
        (2, "\n".join([*other, *passage, line()])),
        (3, "\n".join([line(), *passage, "", *other])),
        (4, "\n".join([passage[0], line(), passage[1]])),
        (5, "\n".join([other[0]] * 6)),
    ]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    got = {r.doc_id: r for r in winnowing.remove(docs).collect()}
    assert got[1].n_removed == got[4].n_removed == 0
    left = lambda d: got[d].clean_text.split("\n")
    assert left(2) == [*other, *passage[3:], rows[1][1].split("\n")[-1]]
    assert left(3) == [rows[2][1].split("\n")[0], ""] or left(3)[0] == rows[2][1].split("\n")[0]
    assert not set(left(3)) & {*passage, *other}
    assert set(left(5)) == {other[0]} and len(left(5)) < 6



def earlier_runs_only(rows, min_words):
    """Lines left when each shared run of lines with ``min_words`` words stays at its first place."""
    texts = [text.split("\n") for _, text in sorted(rows)]
    seen, clean = set(), []
    for lines in texts:
        gone = set()
        for i in range(len(lines)):
            for j in range(i + 1, len(lines) + 1):
                run = tuple(lines[i:j])
                if sum(len(x.split()) for x in run) >= min_words and run in seen:
                    gone.update(range(i, j))
                seen.add(run)
        clean.append("\n".join(x for i, x in enumerate(lines) if i not in gone))
    return dict(zip(sorted(r[0] for r in rows), clean, strict=True))


def test_winnowed_runs_of_one_and_two_lines(spark):
    rng = random.Random(9)
    line = lambda n: " ".join(words(rng, n, 10**6))
    one, two = line(60), [line(30), line(25)]
    rows = [
        (1, "\n".join([line(9), one, line(9), *two, line(9)])),
        (2, "\n".join([line(40), one, line(40)])),
        (3, one),
        (4, "\n".join([*(line(8) for _ in range(3)), *two, line(30)])),
    ]
    lines = [line(n) for n in (2, 4, 7, 7, 11, 15, 25)]
    rows += [(10 + i, "\n".join(rng.choice(lines) for _ in range(rng.randrange(1, 9)))) for i in range(60)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    got = {r.doc_id: r for r in winnowing.remove(docs).collect()}
    texts = dict(rows)
    assert one not in got[2].clean_text and got[3].clean_text == ""
    assert not set(two) & set(got[4].clean_text.split("\n"))
    left = earlier_runs_only(rows, 20)
    assert {d: r.clean_text for d, r in got.items()} == left
    for r in got.values():
        assert all(texts[r.doc_id][start:end] in texts[keep_id] for start, end, keep_id in r.removed)


def test_winnowed_runs_past_the_first_text(spark):
    """The text that has the start of a passage first may lack the rest of it."""
    rng = random.Random(10)
    line = lambda n: " ".join(words(rng, n, 10**6))
    rows = []
    for k in range(12):
        a, b, c = (line(n) for n in ((9, 9, 45), (18, 18, 18), (45, 9, 9))[k % 3])
        rows += [(10 * k + 1, f"{a}\n{b}"), (10 * k + 2, f"{a}\n{b}\n{c}"), (10 * k + 3, f"{a}\n{b}\n{c}\n{line(5)}")]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    got = {r.doc_id: r.clean_text for r in winnowing.remove(docs).collect()}
    assert got == earlier_runs_only(rows, 20)
    assert all(len(got[10 * k + 3].split()) == 5 for k in range(12))


PAGE = """<html><head><title>t</title><script>if (a < b) "</p>"</script></head><body><nav><a>x</a></nav>
<div class="box"><p>Follow us</p></div>{body}<footer>&copy; f</footer></body></html>"""


def test_templates(spark):
    article = "<article><header><h1>T{i}</h1></header><p>one <b>t&amp;wo</b>&nbsp;x<br>three {i}</p><p>Shared</p>{x}</article>"
    extra = '<div id="comments"><p>hi</p></div><div class="ad">buy</div><form>f</form><ul><li>a<li>b</ul>'
    rows = [(i, "http://h.org/a", PAGE.format(body=article.format(i=i, x=extra))) for i in range(8)]
    rows += [(100 + i, "https://n.org", PAGE.format(body=f"<p>text {i}</p>")) for i in range(8)]
    rows += [(200, "https://once.org", PAGE.format(body="<p>only</p>")), (201, None, None), (202, "x", "<p>a<p>b")]
    rows += [(203, "https://copy.org", PAGE.format(body="<article><div>same</div></article>"))] * 9
    pages = spark.createDataFrame(rows, "page_id long, url string, html string").repartition(3)
    got = {r.page_id: r for r in templates.extract(pages).collect()}
    assert got[3].text == "T3\none t&wo x three 3\nShared\na\nb"
    assert got[104].text == "text 4"  # the box recurs on the host
    assert got[200].text == "Follow us\nonly"
    assert (got[201].text, got[201].n_chars) == ("", 0) and got[202].text == "a\nb"
    assert got[203].text == "same"
    assert templates.extract(pages.limit(0)).count() == 0


def test_template_of_a_section(spark):
    """A box on 5 % of a large host's pages is a template, one on a few of them is none."""
    page = "<html><body><article><h1>T{i}</h1>{x}<p>text {i}</p></article></body></html>"
    box = lambda i: "<div>Section box</div>" if i < 20 else "<div>Seldom</div>" if i < 25 else ""
    rows = [(i, f"http://big.org/{i}", page.format(i=i, x=box(i))) for i in range(400)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string").repartition(3)
    got = {r.page_id: r.text for r in templates.extract(pages).collect()}
    for i in range(400):
        assert got[i] == (f"T{i}\nSeldom\ntext {i}" if 20 <= i < 25 else f"T{i}\ntext {i}")


def test_marked_boxes_around_the_article():
    article = "<article><h1>Title</h1><p>All of the text of this page</p></article>"
    side = '<aside><p>Side</p></aside><div class="sidebar"><a>x</a></div>'
    text = lambda html: "\n".join(b.text for b in templates.Page(html).main_blocks())
    for opening in (
        '<div class="layout has-sidebar">', '<div class="no-sidebar">', '<div class="side-by-side">',
        '<div class="widget">', '<form action="/">', '<main><form>', '<div id="nav"><div class="social">',
    ):
        close = "".join(f"</{t}>" for t in reversed(re.findall(r"<(\w+)", opening)))
        page = f"<html><body><nav><a>Home</a></nav>{opening}{article}{side}{close}<footer>f</footer></body></html>"
        assert text(page) == "Title\nAll of the text of this page"
    assert text(f"<form><p>Long text of a page</p><div>and more</div>{side}</form>") == "Long text of a page\nand more"
    comment = "<div class='comments'><article><p>{}</p></article></div>"
    assert text(article + comment.format("A comment")) == text(article)
    inside = article.replace("</article>", comment.format("A comment that is longer than the text " * 3) + "</article>")
    assert text(inside) == text(article)


def test_language_accuracy(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    model = languages.fit(docs.where(~languages.held_out()))
    found = languages.identify(docs, model).join(docs.where(languages.held_out()), "doc_id")
    right = found.selectExpr("avg(cast(lang_pred = lang as double))", "count(*)").first()
    assert right[1] > 100 and right[0] > 0.97


def test_language_odd_rows(odd_docs, no_docs):
    model = languages.fit(odd_docs, min_docs=1)
    assert model.names == ["en"]
    got = {r.doc_id: r for r in languages.identify(odd_docs, model).collect()}
    for doc_id, text in odd_docs.select("doc_id", "text").collect():
        none = not any(c.isalpha() for c in text or "")
        assert got[doc_id].lang_pred == ("und" if none else "en") and 0 <= got[doc_id].score <= 1
    nothing = languages.fit(no_docs)
    assert languages.identify(no_docs, nothing).count() == 0
    assert {r.lang_pred for r in languages.identify(odd_docs, nothing).collect()} == {"und"}


def test_more_languages_than_a_byte_has_bits(spark):
    rng = random.Random(8)
    rows = []
    for k in range(11):
        letters = [chr(0x430 + 3 * k + j) for j in range(3)] + ["x"]
        for i in range(12):
            text = " ".join("".join(rng.choices(letters, k=5)) for _ in range(60))
            rows.append((len(rows), text, f"l{k:02}"))
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    model = languages.fit(docs)
    got = languages.identify(docs, model).join(docs, "doc_id").where("lang_pred = lang").count()
    assert got > 0.95 * len(rows)
