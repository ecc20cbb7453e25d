import html
import itertools
import re

import numpy as np
import plain
from pyspark.sql import functions as F

from paperwarden.llm import html_content, html_tree, quality_classifier as qc
from paperwarden.llm.labelled_pages import labelled_pages
from paperwarden.llm.queries import held_out, op1_quality_classifier


def test_quality_held_out(spark):
    small = "/root/testdata/sf0.01"
    labels = spark.read.parquet(f"{small}/labels.parquet")
    found = op1_quality_classifier(spark, small).join(labels, "doc_id").toPandas()
    apart = found[found["held_out"]]
    assert len(apart) > 50
    assert ((apart["score"] >= 0.5) == apart["quality"]).mean() >= 0.9
    assert (apart[apart["quality"] == 1]["score"] >= 0.7).mean() >= 0.9


def test_quality_on_odd_rows(spark):
    docs = plain.odd_docs(spark)
    for labels in ([], [(4, 1), (5, 1)], [(4, 1), (7, 0), (8, 1), (9, None), (9, 0), (77, 1)]):
        given = spark.createDataFrame(labels, "doc_id long, quality int")
        found = qc.score_quality(docs, given, F.lit(True)).collect()
        assert len(found) == len(plain.ODD_ROWS) and all(0 <= r.score <= 1 for r in found)
    assert qc.score_quality(plain.odd_docs(spark, []), given, ~held_out()).count() == 0


def test_neighbour_sums_against_plain_version(spark):
    texts = ["a b c a", "B, b! 12", "", None, "x " * 40]
    sums = np.zeros((qc.BUCKETS, qc.DIMS))
    places, signs = qc.index_vectors()
    known = qc.TokenBuckets()
    for text in texts:
        tokens = qc.token_buckets(text, known)
        for i, j in itertools.permutations(range(len(tokens)), 2):
            if abs(i - j) <= qc.REACH:
                np.add.at(sums[tokens[i]], places[tokens[j]], signs[tokens[j]])
    rows = spark.createDataFrame([(t,) for t in texts], "text string").repartition(2)
    found = np.zeros_like(sums)
    for r in qc.neighbour_sums(rows).collect():
        found[r.bucket] = [r[f"d{i}"] for i in range(qc.DIMS)]
    assert (found == sums).all() and sums.any()


def test_network_learns_and_temperature_calibrates():
    rng = np.random.default_rng(0)
    x = rng.normal(size=(1500, 4))
    chance = 1 / (1 + np.exp(-2 * (x[:, 0] * x[:, 1] + x[:, 2])))
    y = (rng.random(1500) < chance).astype(float)
    net = qc.fit_network(x[:1000], y[:1000])
    p = net.probability(x[1000:])
    assert np.abs(p - chance[1000:]).mean() < 0.15
    assert qc.fit_network(x[:0], y[:0]).probability(x[:3]).tolist() == [0.5] * 3


def small_tree():
    tree = html_tree.parse("<div class=ad><p>one<b>two</b></p></div><p>three")
    assert len(tree.tag) == 8
    return tree


def test_marginals_against_all_states():
    tree = small_tree()
    forest = html_content.Forest.of([tree, tree])
    rng = np.random.default_rng(3)
    model = html_content.PageModel(rng.normal(size=html_content.FEATURES),
                                   rng.normal(size=(len(html_content.KINDS), 2, 2)))
    belief, joint = model.marginals(forest)
    size = len(tree.tag)
    unary = [sum(model.weights[f] for f in seen) for seen in html_content.node_features(tree)]
    total, ones, pairs = 0.0, np.zeros(size), np.zeros((size, 2, 2))
    for state in itertools.product((0, 1), repeat=size):
        odds = sum(u for u, s in zip(unary, state) if s)
        for node in range(1, size):
            odds += model.edges[html_content._kind(tree.tag[node]), state[tree.parent[node]], state[node]]
        weight = np.exp(odds)
        total += weight
        ones += weight * np.array(state)
        for node in range(1, size):
            pairs[node, state[tree.parent[node]], state[node]] += weight
    assert np.allclose(belief, np.tile(ones / total, 2)) and np.allclose(joint[:size], pairs / total)


def test_unseen_layouts():
    model = html_content.fit_pages(labelled_pages())
    pages = labelled_pages(60, seed=77)
    trees = [html_tree.parse(p) for p in pages]
    belief, _ = model.marginals(html_content.Forest.of(trees))
    label = np.concatenate([html_content.main_labels(t) for t in trees])
    text = np.array([tag == "text" for t in trees for tag in t.tag])
    assert ((belief > 0.5) == label)[text].mean() >= 0.97


def test_articles_of_the_given_pages(spark):
    rows = spark.read.parquet("/root/testdata/sf0.01/pages.parquet")
    found = {r.page_id: r.text for r in html_content.extract_main_text(rows).collect()}
    for row in rows.collect():
        inner = re.search(r"<article>(.*)</article>", row.html, re.S)[1]
        parted = re.sub(r"</?(?:p|h1|br)>", " ", inner).replace("<b>", "").replace("</b>", "")
        assert found[row.page_id] == " ".join(html.unescape(parted).split())


def test_blocks_and_broken_markup():
    def whole(page):
        tree = html_tree.parse(page)
        return html_tree.blocks(tree, [True] * len(tree.tag))

    assert whole("<p>a <b>b</b>c<br>d\n\n e<p>f</p>g") == ["a bc d e", "f", "g"]
    assert whole("<script>var t='<p>no</p>'</script><style>x{}</style><p>1 < 2 &amp; 3 &lt;b&gt;</p>") == ["1 < 2 & 3 <b>"]
    assert whole("<ul><li>a<li>b</ul><table><tr><td>c<td>d</table>") == ["a", "b", "c", "d"]
    assert whole("<div>a<!-- <p>no</p> -->b</div><p title='>'>c</p></div></b><!-- open") == ["ab", "c"]
    assert whole("<p>x<script>never closed") == ["x"] and whole("") == whole(None) == []
    assert whole("<div>" * 2000 + "deep") == ["deep"]


def test_pages_on_odd_rows(spark):
    page = ("<body><nav><a href=/>Home</a></nav><article><h1>T</h1><p>" + "Long text, really. " * 5000
            + "</p></article><footer>&copy; us</footer>")
    rows = [(1, "u", None), (2, None, ""), (None, "u", "no markup at all"), (3, "u", page), (3, "u", page),
            (4, "u", "<nav><a>x</a></nav>"), (5, "u", "<" * 500)]
    pages = spark.createDataFrame([(*r, "a", "b") for r in rows], "page_id long, url string, html string, text string, "
                                                                  "n_chars string")
    found = html_content.extract_main_text(pages)
    assert found.columns == ["page_id", "url", "text"]
    by_id = {}
    for r in found.collect():
        by_id.setdefault(r.page_id, []).append(r.text)
    assert by_id[1] == by_id[2] == by_id[4] == [""]
    assert by_id[3] == [("T " + "Long text, really. " * 5000).strip()] * 2
    assert sum(map(len, by_id.values())) == len(rows)
    assert html_content.extract_main_text(pages.where("false")).count() == 0
