"""HTML extraction, embedding near-duplicates and the pipeline against plain Python."""

import collections
import math

import corpus_pipeline
import duckdb
import numpy as np
import pytest
from conftest import SF_DIR
from test_text_operators import ODD, SCHEMA, brute_components

from edgelens.llm import html_extract, lang_id, mixing, queries
from edgelens.llm.nn_descent import NEIGHBOURS, embedding_near_duplicates

# ------------------------------------------------------------------------------ embeddings


def brute_links(rows, threshold=0.98):
    """(id, links, component) of each row, by comparing all rows."""
    units = []
    for _, vector, label in rows:
        good = label is not None and vector and all(x is not None and math.isfinite(x) for x in vector) and any(vector)
        units.append(np.array(vector, float) / np.linalg.norm(np.array(vector, float)) if good else None)
    n, parent = len(rows), list(range(len(rows)))
    links = [0] * n

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i in range(n):
        for j in range(i):
            if units[i] is None or units[j] is None or rows[i][2] != rows[j][2] or len(units[i]) != len(units[j]):
                continue
            if units[i] @ units[j] >= threshold:
                links[i] += 1
                links[j] += 1
                parent[root(i)] = root(j)
    smallest = {}
    for i, (own, _, _) in enumerate(rows):
        if own is not None:
            smallest[root(i)] = min(own, smallest.get(root(i), own))
    return collections.Counter((rows[i][0], links[i], smallest.get(root(i))) for i in range(n))


def found_links(frame):
    return collections.Counter((r.vec_id, r.n_links, r.component_id) for r in frame.collect())


def given_vectors(spark):
    return [tuple(r) for r in spark.read.parquet(f"{SF_DIR}/embeddings.parquet").select("vec_id", "embedding", "label").collect()]


def test_embedding_query_against_brute_force(spark):
    """No two vectors of this table are near; see the next test for links."""
    result = queries.op8_embedding_near_dedup(spark, SF_DIR)
    assert found_links(result) == brute_links(given_vectors(spark))
    assert all(r.kept == (r.vec_id == r.component_id) for r in result.collect())


def test_embedding_links_of_planted_copies(spark):
    """One to four copies of every other given vector, some just above and some below 0.98."""
    rng = np.random.default_rng(5)
    rows = given_vectors(spark)
    for own, vector, label in rows[::2]:
        size = np.linalg.norm(vector) / np.sqrt(len(vector))
        for k in range(own % 4 + 1):
            noise = rng.standard_normal(len(vector)) * size * (0.05, 0.1, 0.15, 0.25)[k]
            rows.append((10_000 * (k + 1) + own, (np.array(vector) + noise).tolist(), label))
    got = found_links(embedding_near_duplicates(spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int")))
    expected = brute_links(rows)
    links = lambda counts: sum(n * k for (_, n, _), k in counts.items())
    assert sum(got.values()) == len(rows) and links(expected) > 300
    assert 0.97 <= links(got) / links(expected) <= 1


def test_embedding_links_of_a_large_group_and_a_chain(spark):
    """A group larger than a neighbour list, and vectors linked only through others."""
    rng = np.random.default_rng(2)
    centre = rng.standard_normal(32)
    rows = [(i, (centre + 0.02 * rng.standard_normal(32)).tolist(), 1) for i in range(6 * NEIGHBOURS)]
    rows += [(500 + i, [math.cos(0.15 * i), math.sin(0.15 * i)], 2) for i in range(12)]
    rows += [(900 + i, rng.standard_normal(32).tolist(), i % 3) for i in range(200)]
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int")
    assert found_links(embedding_near_duplicates(frame)) == brute_links(rows)


def test_embedding_links_of_odd_rows(spark):
    nan, inf = float("nan"), float("inf")
    vectors = [
        (1, [1.0, 0.0], 1), (2, [2.0, 0.0], 1), (2, [2.0, 0.0], 1), (None, [1.0, 0.0], 1), (3, [1.0, 0.0], 2), (4, [1.0, 0.0], None),
        (5, None, 1), (6, [], 1), (7, [0.0, 0.0], 1), (8, [nan, 1.0], 1), (9, [inf, 1.0], 1), (10, [None, 1.0], 1), (11, [1.0, 0.0, 0.0], 1),
    ]
    rows = [(*v, 0, "x", 1.5, b"", 1) for v in vectors]
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int, node int, vec string, cosine double, group binary, id int")
    assert found_links(embedding_near_duplicates(frame)) == brute_links(vectors)
    assert embedding_near_duplicates(frame.limit(0)).count() == 0


# ------------------------------------------------------------------------------ pages

PAGE = """<html><head><title>T</title><style>p {}</style></head><body><nav><ul><li><a href='#'>Home</a></li><li><a href='#'>About</a></li></ul></nav>
<article><h1>A heading of the article</h1><p>First &amp; longest sentence of the article,
  which   goes on over two lines. It has a second sentence.</p><!-- left out --><script>var a = "<p>no</p>";</script>
<p>Another paragraph follows the first one, and it has some words too.</p></article>
<footer>All rights reserved.</footer></body></html>"""


@pytest.fixture(scope="module")
def labeller(spark):
    return html_extract.train(spark.read.parquet(f"{SF_DIR}/pages.parquet"))


def test_blocks_of_a_page():
    assert [b.text for b in html_extract.blocks_of(PAGE)] == [
        "Home", "About", "A heading of the article",
        "First & longest sentence of the article, which goes on over two lines. It has a second sentence.",
        "Another paragraph follows the first one, and it has some words too.", "All rights reserved.",
    ]
    assert html_extract.blocks_of("") == []
    assert [b.text for b in html_extract.blocks_of("a < b <p>c<div>d")] == ["a < b", "c", "d"]
    assert [b.text for b in html_extract.blocks_of("<p>x<!-- never closed <p>y")] == ["x"]


def test_labels_of_pages_not_seen(labeller):
    rng = np.random.default_rng(1234)
    article = [f"Sentence {i} of an article that nobody has trained on, with some more words." for i in range(6)]
    beside = ["Sign in", "Read more", "Terms of use", "Our partners", "Share this page", "Latest posts"]
    right = total = 0
    for _ in range(100):
        blocks, labels = html_extract.compose(rng, article, beside)
        found = labeller.probabilities([html_extract.features(blocks)])[0] >= 0.5
        right, total = right + int((found == (labels > 0)).sum()), total + len(labels)
    assert right / total >= 0.95


def test_extraction_of_odd_pages(spark, labeller):
    long_page = "<html><body><article>" + "<p>Some words of a long article.</p>" * 30_000 + "</article></body></html>"
    rows = [(1, "u", PAGE, "x"), (1, "u", PAGE, "x"), (2, None, None, "x"), (3, "u", "", "x"), (None, "u", "<script>x", "x"), (4, "u", long_page, "x")]
    frame = spark.createDataFrame(rows, "page_id long, url string, html string, text string")
    got = [(r.page_id, r.text, r.n_chars) for r in html_extract.extract_main_text(frame, labeller).collect()]
    assert len(got) == len(rows) and all(len(text) == n for _, text, n in got)
    first = next(text for own, text, _ in got if own == 1)
    assert "First & longest sentence of the article, which goes on over two lines." in first
    assert "Home" not in first and "rights" not in first
    assert [text for own, text, _ in got if own in (2, 3, None)] == ["", "", ""]
    assert html_extract.extract_main_text(frame.limit(0), labeller).count() == 0


def test_extraction_query_returns_every_page(spark):
    pages = spark.read.parquet(f"{SF_DIR}/pages.parquet")
    rows = queries.op4_html_extraction(spark, SF_DIR).collect()
    assert sorted(r.page_id for r in rows) == sorted(r.page_id for r in pages.select("page_id").collect())
    assert all(r.n_chars == len(r.text) for r in rows)


# ------------------------------------------------------------------------------ pipeline


def squeezed(text):
    return (text or "").translate(dict.fromkeys([32, *range(9, 14)]))


def brute_stages(rows, dictionaries):
    """(doc_id, text, lang, source, n_chars) after the first three stages and after mixing."""
    classify = lang_id.Classifier(dictionaries)

    def clear(text):
        found, margin = classify(text)
        return found != lang_id.UNKNOWN and (margin >= lang_id.MIN_MARGIN or len((text or "").encode()) < lang_id.JUDGED)

    rows = [r for r in rows if clear(r[1])]
    best = {}
    for r in rows:
        rank = (-len(r[1] or ""), r[0])
        if rank < best.get(squeezed(r[1]), ((math.inf,), None))[0]:
            best[squeezed(r[1])] = (rank, r)
    rows = [r for _, r in best.values()]
    classes = brute_components({r[0]: r[1] for r in rows})
    rows = [r for r in rows if classes[r[0]][1] == r[0]]
    database = duckdb.connect()
    database.execute("CREATE TABLE documents (doc_id BIGINT, text VARCHAR, lang VARCHAR, source VARCHAR, n_chars BIGINT)")
    database.executemany("INSERT INTO documents VALUES (?, ?, ?, ?, ?)", rows)
    mixed = []
    own = {r[0]: r for r in rows}
    for doc_id, size, taken in database.execute(f"SELECT doc_id, size, taken FROM ({mixing.ORACLE_SQL})").fetchall():
        mixed += [own[doc_id]] * (taken // size if size else 0)
    return mixed


def test_pipeline_against_brute_force(spark):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    mixed = brute_stages([tuple(r) for r in docs.collect()], lang_id.train(docs))
    got = [r.asDict() for r in corpus_pipeline.run(spark, SF_DIR).collect()]
    assert mixed and {g["doc_id"] for g in got} == {r[0] for r in mixed}
    frame = spark.createDataFrame(mixed, docs.schema)
    expected = corpus_pipeline.pack(spark, frame, SF_DIR).collect()
    piece = lambda r: (r["doc_id"], r["start"], r["length"], r["ids_crc32"], r["doc_tokens"])
    assert collections.Counter(map(piece, got)) == collections.Counter(piece(r.asDict()) for r in expected)
    used = collections.defaultdict(list)
    for g in got:
        used[g["sequence_id"]].append((g["offset"], g["length"]))
    for places in used.values():
        places.sort()
        assert [at for at, _ in places] == [sum(n for _, n in places[:i]) for i in range(len(places))]
        assert sum(n for _, n in places) <= 4096


def test_pipeline_stages_keep_the_columns(spark):
    frame = spark.createDataFrame(ODD, SCHEMA)
    for data in (frame, frame.limit(0)):
        docs = data
        for _, stage in corpus_pipeline.STAGES[:-1]:
            docs = stage(spark, docs, SF_DIR)
            assert docs.columns == frame.columns
            docs = spark.createDataFrame(docs.collect(), frame.schema)
        assert corpus_pipeline.pack(spark, docs, SF_DIR).count() >= docs.count()
