import pytest

from vintagelake.llm import html_text

CASES = [
    ("", ""), (None, ""), ("<p>", ""), ("plain & text &lt; 3", "plain & text < 3"),
    ("<article><p>a\n b&nbsp;c<br>d</p>e<section class='comments'><p>zz</section><p>f</article>tail", "a b c d\ne\nf"),
    ("<nav><ul><li>menu</nav><main><h1>T</h1><p>One <b>bold</b> wo<i>r</i>d.<p>Two</main><footer>f</footer>", "T\nOne bold word.\nTwo"),
    ("<article><script>var t='</p>';if(a<b){}</script><style>p{}</style><!-- c --><p>x</p><form><p>name</form></article>", "x"),
    ("<article><h1>A</h1><aside>side</aside><div class='ad-slot'><p>buy</div><p>b<ul><li>one<li>two</ul></article>", "A\nb\none\ntwo"),
    ("<article><header><h1>Head</h1></header><p>body</p><div role=alert>note</div><div id=comments>c</div></article>", "Head\nbody"),
    ("<body class='has-sidebar'><article><p>kept</article>", "kept"),
    ("<article><table><tr><td>1<td>2<tr><td>3</table><pre>x\ty</pre></article>", "1\n2\n3\nx y"),
    ("<article><p>unclosed <b>bold<p>next</article><p>after", "unclosed bold\nnext"),
    ("<article><p>&#8364; &eacute; &amp;amp; &unknown;</p></article>", "€ é &amp; &unknown;"),
]


@pytest.mark.parametrize("html,text", CASES)
def test_cases(html, text):
    assert html_text.main_text(html) == text


def test_ratio_regions_without_a_marked_article():
    long = "A paragraph with quite a number of words that makes up the text of this page. " * 3
    links = "".join(f"<li><a href=/{i}>go {i}</a>" for i in range(12))
    page = f"<body><ul>{links}</ul><div><p>{long}<p>{long}<p>Yes.<p>{long}</div><ul>{links}</ul>"
    one = " ".join(long.split())
    assert html_text.main_text(page) == "\n".join([one, one, "Yes.", one])


def test_operator(spark):
    rows = [(1, "u", CASES[4][0], "x", "y"), (1, "u", CASES[4][0], "x", "y"), (None, None, None, None, None),
            (2, "v", "<article>" + "<p>w</p>" * 20_000 + "</article>", "", "")]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string, text string, n_chars string")
    got = sorted(map(tuple, html_text.extract(pages).collect()), key=str)
    long = "\n".join(["w"] * 20_000)
    assert got == sorted([(1, "u", CASES[4][1], 11), (1, "u", CASES[4][1], 11), (None, None, "", 0), (2, "v", long, 39_999)], key=str)
    assert html_text.extract(pages.limit(0)).count() == 0


def test_ratios_decide_on_pages_with_an_article():
    long = " ".join(["Words of the page that stand in its text."] * 6)
    teaser = "<article><h3><a href=/n>Next</a></h3><p><a href=/n>Go on</a></article>"
    assert html_text.main_text(f"<body><div><h1>T</h1><p>{long}<p>{long}<p>End.</div>{teaser}") == f"T\n{long}\n{long}\nEnd."
    split = html_text.main_text(f"<body><article><h1>T</h1><p>{long}</article><div><p>{long}<p>{long}</div>")
    assert split == f"T\n{long}\n{long}\n{long}"
    assert html_text.main_text(f"<body><p>A short remark.</p><article><p>{long}</article>") == long


def test_names_of_articles_are_checked():
    long = " ".join(["Words of the page that stand in its text."] * 6)
    comment = f"<article class='comment odd'><p>{long} No!</article>"
    assert html_text.main_text(f"<article class='post tag-social'><p>{long}</article>{comment}") == long
    assert html_text.main_text(f"<nav>menu</nav><main class='search'><p>{long}</main>") == long


def test_marks_are_not_needed():
    nav = "<nav><ul>" + "".join(f"<li><a href=/{i}>go {i}</a>" for i in range(9)) + "</ul></nav>"
    page = f"{nav}<div class=ad>Buy more of it.</div><article><h1>T</h1><p>{'word ' * 60}<p>Yes.</article><footer>{'foot ' * 50}</footer>"
    want = "\n".join(["T", ("word " * 60).strip(), "Yes."])
    assert html_text.main_text(page) == want
    assert html_text.main_text(page.replace("article", "div")) == want


def test_many_unmatched_ends_and_unclosed_elements_take_linear_time():
    import time

    body = "<article><p>" + "words of the article " * 40 + "</p></article>"
    for junk in ("</b>" * 50_000, "<i>" * 20_000 + "</b>" * 50_000, "<span>" * 50_000 + "<p>" * 10, "</div>" * 50_000):
        began = time.process_time()
        assert "words of the article" in html_text.main_text(f"<body>{junk}{body}</body>")
        assert time.process_time() - began < 3  # a second here, twice that on a busy machine


def test_smoothing_and_regions_by_definition():
    import math
    import random

    import numpy as np

    rnd = random.Random(6)
    for _ in range(60):
        ratios = [rnd.choice([0.0, 0.5, 3.0, 40.0, 200.0]) * rnd.random() for _ in range(rnd.randrange(1, 40))]
        sigma, deviations = rnd.choice([0.5, 1.0, 2.0]), 1.5
        level = []
        for i in range(len(ratios)):
            near = [(math.exp(-0.5 * ((i - j) / sigma) ** 2), ratios[j]) for j in range(len(ratios)) if abs(i - j) <= math.ceil(3 * sigma)]
            level.append(sum(w * r for w, r in near) / sum(w for w, _ in near))
        assert html_text.smooth(np.array(ratios), sigma).tolist() == pytest.approx(level)
        mean = sum(level) / len(level)
        spread = math.sqrt(sum((x - mean) ** 2 for x in level) / len(level))
        threshold = min(mean, max(mean - deviations * spread, 0.15 * max(level)))
        if any(abs(x - threshold) < 1e-9 for x in level):
            continue
        inside = [x >= threshold and r >= threshold / 2 for x, r in zip(level, ratios, strict=True)]
        held = [i for i, x in enumerate(inside) if x]
        for a, b in zip(held, held[1:]):
            if b - a <= 3:
                inside[a:b] = [True] * (b - a)
        assert html_text.regions(np.array(ratios), sigma, deviations).tolist() == inside
