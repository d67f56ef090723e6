import numpy as np
import pytest

from shelfsight.llm import page_text
from shelfsight.llm.page_text import extract_text, label_pages, leaf_blocks, trained

SCHEMA = "page_id long, url string, html string"


@pytest.mark.parametrize(
    "page, want",
    [
        ("<p>a &amp; b&nbsp;&#233;<p> c\n\td </p>", ["a & b é", "c d"]),
        ("<p>one<br>two <b>th</b>ree", ["one two three"]),
        ('<script>var t="</p><p>x";</script><!-- <p>n --> <style>p{}</style>t', ["t"]),
        ("<ul><li>a<li>b</ul><table><tr><td>c<td>d</table>", ["a", "b", "c", "d"]),
        ("x <a title='a>b'>y</a> 1 < 2 <p hidden>no</p> z", ["x y 1 < 2", "z"]),
        ('<article title="The hidden valley"><p>a</article>', ["a"]),
        ('<div class="md:flex hidden lg:block" data-style="display:none">a</div>', ["a"]),
        ("<ul><li hidden>no<li>a</ul><p>b", ["a", "b"]),
        ("<div><p HIDDEN>no<b>no</div>a <i style='color:red; display: none'>no</i>b", ["a b"]),
        ("<p>It follows that <math><mi>E</mi>=<mi>m</mi></math>. Energy <object>holds</object>.", ["It follows that E=m. Energy holds."]),
        ("<!-- open", []),
        ("", []),
    ],
)
def test_blocks(page, want):
    assert [b.text for b in leaf_blocks(page)] == want


def test_held_out_layouts():
    rng, right, total = np.random.default_rng(77), 0, 0
    for _ in range(60):
        blocks = leaf_blocks(page_text.made_page(rng))
        labels = np.array([page_text._MAIN in b.text for b in blocks])
        for b in blocks:
            b.text = b.text.replace(page_text._MAIN, "").replace(page_text._REST, "") or "x"
        right, total = right + (label_pages([blocks], trained())[0] == labels).sum(), total + len(labels)
    assert right / total > 0.98


def test_gradients_are_those_of_the_loss():
    rng = np.random.default_rng(1)
    net = page_text.Network(rng, width=5, units=3)
    net.weights = {k: v.astype(np.float64) for k, v in net.weights.items()}
    x, mask = rng.normal(size=(4, 2, 5)), np.array([[1, 1], [1, 1], [1, 0], [1, 0]], float)
    y = rng.integers(0, 2, (4, 2)).astype(float)

    def loss():
        p = np.clip(net.forward(x, mask)[0], 1e-9, 1 - 1e-9)
        return -(mask * (y * np.log(p) + (1 - y) * np.log(1 - p))).sum() / mask.sum()

    for name, g in net.gradients(x, y, mask).items():
        w = net.weights[name]
        at = tuple(rng.integers(0, s) for s in w.shape)
        before = w[at]
        w[at] = before + 1e-3
        high = loss()
        w[at] = before - 1e-3
        assert g[at] == pytest.approx((high - loss()) / 2e-3, abs=2e-4)
        w[at] = before


def test_pages_of_one_batch_do_not_touch(spark):
    rng = np.random.default_rng(5)
    pages = [leaf_blocks(page_text.made_page(rng)) for _ in range(12)]
    together = label_pages(pages, trained())
    assert all((label_pages([p], trained())[0] == t).all() for p, t in zip(pages, together, strict=True))


def test_articles_of_the_table(spark, sf_dir):
    table = spark.read.parquet(f"{sf_dir}/pages.parquet")
    html = {r.page_id: r.html for r in table.collect()}
    rows = extract_text(table).collect()
    assert len(rows) == len(html)
    same = sum(
        r.text == "\n\n".join(b.text for b in leaf_blocks(html[r.page_id]) if "article" in b.path)
        for r in rows
    )
    assert same / len(rows) > 0.98
    assert all(r.n_chars == len(r.text) for r in rows)


def test_nulls_long_pages_and_further_columns(spark):
    long = "<article>" + "<p>some words of a text.</p>" * 20_000 + "</article>"
    rows = [(1, None, None), (2, "u", ""), (None, "u", "<nav>menu</nav>"), (3, "u", long), (3, "u", long)]
    table = spark.createDataFrame(rows, SCHEMA).selectExpr("*", "1 as text", "2 as n_chars")
    got = sorted((str(r.page_id), r.n_chars) for r in extract_text(table).collect())
    assert got == [("1", 0), ("2", 0), ("3", 459_998), ("3", 459_998), ("None", 0)]
    assert extract_text(table.limit(0)).count() == 0
