"""Segmentation on published rule cases, and main text on annotated pages."""

import random

import pytest

from corvane.functions.maintext import extract
from corvane.functions.segment import sentences

#: Line and its sentences.
CASES = [
    ("Hello World. My name is Jonas.", ["Hello World.", "My name is Jonas."]),
    ("What is your name? My name is Jonas.", ["What is your name?", "My name is Jonas."]),
    ("There it is! I found it.", ["There it is!", "I found it."]),
    ("My name is Jonas E. Smith.", ["My name is Jonas E. Smith."]),
    ("Please turn to p. 55.", ["Please turn to p. 55."]),
    ("Were Jane and co. at the party?", ["Were Jane and co. at the party?"]),
    ("They closed the deal with Pitt, Briggs & Co. at noon.", ["They closed the deal with Pitt, Briggs & Co. at noon."]),
    ("Let's ask Jane and co. They should know.", ["Let's ask Jane and co.", "They should know."]),
    ("They closed the deal with Pitt, Briggs & Co. It closed yesterday.", ["They closed the deal with Pitt, Briggs & Co.", "It closed yesterday."]),
    ("I can see Mt. Fuji from here.", ["I can see Mt. Fuji from here."]),
    ("St. Michael's Church is on 5th st. near the light.", ["St. Michael's Church is on 5th st. near the light."]),
    ("That is JFK Jr.'s book.", ["That is JFK Jr.'s book."]),
    ("I visited the U.S.A. last year.", ["I visited the U.S.A. last year."]),
    ("I live in the E.U. How about you?", ["I live in the E.U.", "How about you?"]),
    ("I live in the U.S. How about you?", ["I live in the U.S.", "How about you?"]),
    ("I work for the U.S. Government in Virginia.", ["I work for the U.S. Government in Virginia."]),
    ("I have lived in the U.S. for 20 years.", ["I have lived in the U.S. for 20 years."]),
    ("At 5 a.m. Mr. Smith went to the bank. He left the bank at 6 P.M. Mr. Smith then went to the store.", ["At 5 a.m. Mr. Smith went to the bank.", "He left the bank at 6 P.M.", "Mr. Smith then went to the store."]),
    ("She has $100.00 in her bag.", ["She has $100.00 in her bag."]),
    ("She has $100.00. It is in her bag.", ["She has $100.00.", "It is in her bag."]),
    ("He teaches science (He previously worked for 5 years as an engineer.) at the local University.", ["He teaches science (He previously worked for 5 years as an engineer.) at the local University."]),
    ("Her email is Jane.Doe@example.com. I sent her an email.", ["Her email is Jane.Doe@example.com.", "I sent her an email."]),
    ("The site is: https://www.example.50.com/new-site/awesome_content.html. Please check it out.", ["The site is: https://www.example.50.com/new-site/awesome_content.html.", "Please check it out."]),
    ("She turned to him, 'This is great.' she said.", ["She turned to him, 'This is great.' she said."]),
    ('She turned to him, "This is great." she said.', ['She turned to him, "This is great." she said.']),
    ('She turned to him, "This is great." She held the book out to show him.', ['She turned to him, "This is great."', "She held the book out to show him."]),
    ("Hello!! Long time no see.", ["Hello!!", "Long time no see."]),
    ("Hello?? Who is there?", ["Hello??", "Who is there?"]),
    ("Hello!? Is that you?", ["Hello!?", "Is that you?"]),
    ("Hello?! Is that you?", ["Hello?!", "Is that you?"]),
    ("1.) The first item 2.) The second item", ["1.) The first item", "2.) The second item"]),
    ("1.) The first item. 2.) The second item.", ["1.) The first item.", "2.) The second item."]),
    ("1) The first item 2) The second item", ["1) The first item", "2) The second item"]),
    ("1) The first item. 2) The second item.", ["1) The first item.", "2) The second item."]),
    ("1. The first item 2. The second item", ["1. The first item", "2. The second item"]),
    ("1. The first item. 2. The second item.", ["1. The first item.", "2. The second item."]),
    ("• 9. The first item • 10. The second item", ["• 9. The first item", "• 10. The second item"]),
    ("⁃9. The first item ⁃10. The second item", ["⁃9. The first item", "⁃10. The second item"]),
    ("a. The first item b. The second item c. The third list item", ["a. The first item", "b. The second item", "c. The third list item"]),
    ("You can find it at N°. 1026.253.553. That is where the treasure is.", ["You can find it at N°. 1026.253.553.", "That is where the treasure is."]),
    ("She works at Yahoo! in the accounting department.", ["She works at Yahoo! in the accounting department."]),
    ("We make a good team, you and I. Did you see Albert I. Jones yesterday?", ["We make a good team, you and I.", "Did you see Albert I. Jones yesterday?"]),
    ("Thoreau argues that by simplifying one’s life, “the laws of the universe will appear less complex. . . .”", ["Thoreau argues that by simplifying one’s life, “the laws of the universe will appear less complex. . . .”"]),
    ('"Bohr [...] used the analogy of parallel stairways [...]" (Smith 55).', ['"Bohr [...] used the analogy of parallel stairways [...]" (Smith 55).']),
    ("If words are left off at the end of a sentence, and that is all that is omitted, indicate the omission with ellipsis marks (preceded and followed by a space) and then indicate the end of the sentence with a period . . . . Next sentence.", ["If words are left off at the end of a sentence, and that is all that is omitted, indicate the omission with ellipsis marks (preceded and followed by a space) and then indicate the end of the sentence with a period . . . .", "Next sentence."]),
    ("I never meant that.... She left the store.", ["I never meant that....", "She left the store."]),
    ("I wasn’t really ... well, what I mean...see . . . what I'm saying, the thing is . . . I didn’t mean it.", ["I wasn’t really ... well, what I mean...see . . . what I'm saying, the thing is . . . I didn’t mean it."]),
    ("One further habit which was somewhat weakened . . . was that of combining words into self-interpreting compounds. . . . The practice was not abandoned. . . .", ["One further habit which was somewhat weakened . . . was that of combining words into self-interpreting compounds.", ". . . The practice was not abandoned. . . ."]),
    ("Hello world.Today is Tuesday.Mr. Smith went to the store and bought 1,000.That is a lot.", ["Hello world.", "Today is Tuesday.", "Mr. Smith went to the store and bought 1,000.", "That is a lot."]),
    ("The missile hit Col. Smith's post. Gen. Lee did not answer.", ["The missile hit Col. Smith's post.", "Gen. Lee did not answer."]),
    ("", []),
    ("   ", []),
]


@pytest.mark.parametrize(("line", "parts"), CASES)
def test_sentences(line, parts):
    assert sentences(line) == parts


def test_sentences_lose_nothing():
    rng = random.Random(3)
    for _ in range(2_000):
        line = "".join(rng.choice(["a", "Bc", "I", " ", ". ", "...", '"', "(", ")", "U.S.", "1. ", "2. ", "?", " Mr.", "'", "\t", "é"]) for _ in range(rng.randint(0, 25)))
        assert "".join("".join(sentences(line)).split()) == "".join(line.split())


# ---- main text: layouts with their paragraphs marked

WORDS = "river council vote storm bridge school market garden engine winter letter harbour signal forest paper window morning factory doctor border".split()


def _prose(rng, n):
    return " ".join(rng.choice(WORDS) for _ in range(n)).capitalize() + ", and so on."


def _links(rng, n, wrap="li"):
    return "".join(f"<{wrap}><a href='/{i}'>{rng.choice(WORDS)} {rng.choice(WORDS)} {rng.choice(WORDS)} today</a></{wrap}>" for i in range(n))


LAYOUTS = {
    "article": lambda r, ps: f"<nav><ul>{_links(r, 9)}</ul></nav><article><h1>T</h1>{''.join(f'<p>{p}</p>' for p in ps)}</article><footer>{_prose(r, 9)}</footer>",
    "divs": lambda r, ps: f"<div class=menu>{_links(r, 9, 'div')}</div><div id=content><div class=story>{''.join(f'<p>{p}</p>' for p in ps)}</div></div><div class=sidebar><p>{_prose(r, 30)}</p></div>",
    "text in divs": lambda r, ps: f"<div><div>{_links(r, 8, 'div')}</div><div>{''.join(f'<div>{p}</div>' for p in ps)}</div></div>",
    "line breaks": lambda r, ps: f"<div class=head>{_prose(r, 4)}</div><div class=body>{'<br><br>'.join(ps)}</div><ul>{_links(r, 12)}</ul>",
    "open paragraphs": lambda r, ps: f"<body><ul>{_links(r, 6)}</ul><article>{''.join(f'<p>{p}' for p in ps)}</article><footer><p>{_prose(r, 12)}</footer>",
    "comments": lambda r, ps: f"<main>{''.join(f'<p>{p}</p>' for p in ps)}<div class=comments>{''.join(f'<p>{_prose(r, 25)}</p>' for _ in range(3))}</div></main>",
    "related inside": lambda r, ps: f"<article><p>{ps[0]}</p><div class='related box'><p>{_prose(r, 20)}</p></div>{''.join(f'<p>{p}</p>' for p in ps[1:])}<ul>{_links(r, 5)}</ul></article>",
    "sections": lambda r, ps: f"<div class=page>{''.join(f'<section><p>{a}</p></section>' for a in ps)}</div><aside><p>{_prose(r, 40)}</p></aside>",
    "table of links": lambda r, ps: f"<table><tr>{_links(r, 20, 'td')}</tr></table><div class=post><blockquote>{ps[0]}</blockquote>{''.join(f'<p>{p}</p>' for p in ps[1:])}</div>",
    "teasers": lambda r, ps: f"<article>{''.join(f'<p>{p}</p>' for p in ps)}</article><div class=list>{''.join(f'<div class=teaser><p>{_prose(r, 12)}</p></div>' for _ in range(5))}</div>",
    "links in prose": lambda r, ps: f"<div class=x>{''.join(f'<p>{p} <a href=/a>{r.choice(WORDS)}</a></p>' for p in ps)}</div><div class=y>{_links(r, 15, 'p')}</div>",
    "scripts": lambda r, ps: f"<script>var a='<p>{_prose(r, 30)}</p>';</script><style>p{{}}</style><div>{''.join(f'<p>{p}</p><script>x()</script>' for p in ps)}</div><form><p>{_prose(r, 30)}</p></form><div class=cookie><p>{_prose(r, 22)}</p></div>",
}


def test_main_text_of_annotated_pages():
    """Precision and recall in words, over all layouts; each page keeps every paragraph."""
    rng = random.Random(5)
    right = given = wanted = 0
    for name, layout in LAYOUTS.items():
        paragraphs = [_prose(rng, rng.randint(15, 60)) for _ in range(rng.randint(4, 8))]
        got = extract(f"<html><head><title> A  title </title><meta property='article:published_time' content='2024-05-06'></head>{layout(rng, paragraphs)}</html>")
        assert got["title"] == "A title" and got["date"] == "2024-05-06"
        lines = got["text"].split("\n")
        kept = [p for p in paragraphs if any(line.startswith(p) for line in lines)]
        assert len(kept) == len(paragraphs), name
        right += sum(len(p.split()) for p in kept)
        wanted += sum(len(p.split()) for p in paragraphs)
        given += len(got["text"].split())
    assert right / wanted == 1.0
    assert right / given >= 0.97


@pytest.mark.parametrize("html", ["", "<p>", "no tags", "<div><p>a<b>c</div></p></i>", "<a href=x>only a link</a>", "<!-- x --><script>x</script>", "<ul>" * 300 + "deep" + "</ul>" * 300])
def test_odd_pages(html):
    got = extract(html)
    assert got is None or got["text"]


def test_short_pages_keep_their_text():
    assert extract("<title>t</title><nav><a>x</a></nav><article><h1>Hello</h1><p>Short.</article>")["text"] == "Hello\nShort."
    assert extract("<body><time datetime='2023-01-02'>x</time><div class='related box'>noise</div><p>Short text.</p>") == {"title": "", "date": "2023-01-02", "text": "x\nShort text."}


def test_normal_forms_of_whole_texts_take_few_rows_at_a_time(spark):
    from corvane.functions.text import norm

    rows = spark.createDataFrame([("Ｔhe  ‘A’",), (None,), ("",)], "text string").select(norm("text").alias("plain"))
    plan = rows._jdf.queryExecution().executedPlan().toString()
    assert "BatchEvalPython" in plan and "ArrowEvalPython" not in plan
    assert [r["plain"] for r in rows.collect()] == ["the ‘a'", None, ""]
