"""Pages with stray raw elements, tokenizers of other kinds, and samples for training."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from edgelens.llm.html_extract import blocks_of
from edgelens.llm.packing import CAPACITY, default_tokenizer, encoder, in_chunks, pack_documents
from edgelens.llm.sample import hashed_sample


def texts_of(page):
    return [b.text for b in blocks_of(page)]


@pytest.mark.parametrize(
    "stray", ["<svg/>", "<svg viewBox='0' />", "<math/>", "<select>", "<noscript>", "<svg>", "<object data=x>", "<textarea>", "<video/>"]
)
def test_stray_raw_elements_lose_no_text(stray):
    page = f"<article><p>Hello there.</p>{stray}<p>World of text.</p>{stray}<p>End.</p></article>"
    assert texts_of(page) == ["Hello there.", "World of text.", "End."]


def test_raw_elements_hold_no_text():
    page = (
        "<p>One.</p><svg><svg><text>in</text></svg><text>out</text></svg><p>Two.</p><select><option>x</option></select>"
        "<p>Three.</p><svg><path/><svg/></svg><p>Four.</p><script>if (a < b) { '<p>no</p>' }</script><p>Five.</p><style>p {}"
    )
    assert texts_of(page) == ["One.", "Two.", "Three.", "Four.", "Five."]


def test_very_many_stray_elements():
    page = "<p>a</p>" + "<svg><select>" * 20_000 + "<p>b</p>"
    assert texts_of(page) == ["a", "b"]


TEXTS = [
    "", "Hello, World. it's 3 o'clock!! don't... x&&& é, Été. naïve$$$ ÉÉ?! (brackets) _under_score_ a_b.",
    "Ångström étude ﬁne Straße ǅ İstanbul ΣΑΣ. ²³ ½. 12.5% x'll x'LL. 'tis.", "tabs\tand\nlines   nbsp sep",
    "<|endoftext|> a<|endoftext|>b <|startoftext|>. <|ENDOFTEXT|>", "日本語、テキスト。 한국어. mixed日本.", "word " * 3000 + "end.",
]


@pytest.mark.parametrize("name", ["word_bpe_49k.json", "byte_bpe_50k.json"])
def test_ids_are_those_of_the_tokenizer(name):
    import public_tokenizers
    from tokenizers import Tokenizer

    path = public_tokenizers.path(name)
    assert in_chunks(path) == (path == default_tokenizer())
    plain = Tokenizer.from_file(path)
    expected = [plain.encode(x, add_special_tokens=False).ids for x in TEXTS]
    encode = encoder(path)
    for batch in (TEXTS, TEXTS[::-1], TEXTS * 2):
        found = [np.frombuffer(x, "<u4").tolist() for x in encode(batch)]
        assert found == [expected[TEXTS.index(x)] for x in batch]


def test_repeated_rows_are_dealt_to_many_blocks(spark):
    docs = spark.range(12_000).select(F.lit(None).cast("long").alias("doc_id"), F.expr("repeat('word ', 99)").alias("text"))
    pieces = pack_documents(docs)
    blocks = pieces.groupBy(F.expr("shiftright(sequence_id, 32)").alias("b")).agg(F.sum("length").alias("n")).collect()
    assert len(blocks) > 1 and max(b.n for b in blocks) < 2 * 128 * CAPACITY
    assert sum(b.n for b in blocks) == 1_200_000


def test_samples_are_bounded_and_alike_at_every_partitioning(spark):
    rows = [(i % 700 if i % 5 else None, f"text {i % 700}") for i in range(3000)] + [(9000, None), (9001, "")]
    frame = spark.createDataFrame(rows, "id long, text string")
    first = hashed_sample(frame, "id", F.col("text"), 50)
    assert len(first) == 50 and None not in first
    assert hashed_sample(frame.repartition(7), "id", F.col("text"), 50) == first
    assert len(hashed_sample(frame, "id", F.col("text"), 10_000)) == len({r[0] for r in rows if r[1] is not None})
    assert hashed_sample(frame.limit(0), "id", F.col("text"), 50) == []
