"""Quality rules, spelling variants and conversation repair against plain Python."""

import hashlib
import itertools
import re
import zlib
from collections import Counter

import numpy as np
import pytest

from edgelens.llm import conversation_repair, spelling
from edgelens.llm.quality_rules import language_references, quality_rules

WORDS = re.compile(r"[^\x20\x09-\x0D]+")
DOCS = "doc_id long, text string, lang string, words string, n_words int, `a.b` int, word string, n int"


def documents(spark, rows):
    """Rows of (id, text, lang), with further columns whose names clash with working columns."""
    return spark.createDataFrame([(*row, "w", 1, 2, "x", 3) for row in rows], DOCS)


# ------------------------------------------------------------------------------ quality rules


def plain_counts(text):
    words = WORDS.findall(text or "")
    lines = [x for x in (text or "").split("\n") if WORDS.search(x)]
    windows = [tuple(words[i : i + 5]) for i in range(len(words) - 4)]
    often = Counter(windows)
    covered = {i + j for i, w in enumerate(windows) if often[w] > 1 for j in range(5)}
    failed = len(words) < 10 or 100 * len(covered) > 20 * len(words)
    symbols = sum(c in "#*$%&|<>" for c in text or "")
    return len(words), sum(map(len, words)), symbols, len(lines) - len(set(lines)), len(covered), failed


PROSE = "the cat sat on the mat and the dog lay in the sun while the bird sang of the sea "
ODD_TEXTS = [
    None,
    "",
    " \n\t",
    "one two three",
    "a b c d e " * 3,
    "x " * 12,
    "line of words\nline of words\n \n\nline of words\rother",
    "é😀 # $ % & | < > * and some more words of a line that go on and on",
    "  no break   kept as words " * 3,
    PROSE * 3000,
    " ".join(f"w{i}" for i in range(40_000)),
    " ".join(f"w{i % 7000}" for i in range(21_000)),
]


def test_counts_of_odd_texts(spark):
    rows = [(i, text, "en") for i, text in enumerate(ODD_TEXTS)]
    rows += [(None, ODD_TEXTS[7], None), (3, ODD_TEXTS[3], "en"), (3, ODD_TEXTS[3], "en")]
    found = quality_rules(documents(spark, rows)).collect()
    got = Counter((r.doc_id, r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words, r.base_failed) for r in found)
    assert got == Counter((i, *plain_counts(text)) for i, text, _ in rows)
    assert not any(r.kept for r in found if r.base_failed)


def test_counts_of_random_repeats(spark):
    rng = np.random.default_rng(1)
    rows = []
    for i in range(300):
        words = [str(x) for x in rng.integers(0, rng.integers(2, 60), rng.integers(0, 80))]
        rows.append((i, " ".join(words), "en"))
    found = quality_rules(documents(spark, rows)).collect()
    got = {r.doc_id: (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words, r.base_failed) for r in found}
    assert got == {i: plain_counts(text) for i, text, _ in rows}


@pytest.fixture(scope="module")
def prose():
    rng = np.random.default_rng(2)
    common = "the of and to in a is that it was for on are as with his they at be this".split()
    rare = ["".join(rng.choice(list("etaoinshrdlu"), rng.integers(3, 9))) for _ in range(4000)]

    def text(n):
        return " ".join(common[int(20 * rng.random() ** 2)] if rng.random() < 0.5 else rare[rng.integers(4000)] for _ in range(n)) + "."

    return text


def test_verdicts_of_clean_and_odd_documents(spark, prose):
    clean = [(i, prose(30 + 3 * i), "en") for i in range(200)]
    loud = [(1000 + i, prose(60).upper(), "en") for i in range(5)]
    marked = [(2000 + i, prose(60).replace(" ", "$$$ "), "en") for i in range(5)]
    listed = [(3000 + i, " | ".join(f"item{i}x{j}" for j in range(60)), "en") for i in range(5)]
    short = [(4000, "FEW LOUD WORDS OF A DOC HERE AND ONE MORE", "en")]
    verdicts = {r.doc_id: r.kept for r in quality_rules(documents(spark, clean + loud + marked + listed + short)).collect()}
    assert all(verdicts[i] for i, *_ in clean + short)
    assert not any(verdicts[i] for i, *_ in loud + marked + listed)


def test_rare_and_missing_languages_use_all_documents(spark, prose):
    rows = [(i, prose(200), "en") for i in range(40)] + [(100, prose(200), "xx"), (101, prose(200), None)]
    docs = documents(spark, rows)
    references = language_references(docs).collect()
    assert sorted((r.lang, r.pooled) for r in references if r.lang) == [("en", False)]
    assert [len(r.words) for r in references if r.pooled] == [32]
    for r in references:
        assert abs(sum(r.word_p) - 1) < 1e-9 and list(r.word_p[:-1]) == sorted(r.word_p[:-1], reverse=True)
    found = {r.doc_id: r for r in quality_rules(docs).collect()}
    assert found[100].kept and found[101].kept and found[101].word_divergence is not None


def test_quality_of_an_empty_table(spark):
    empty = documents(spark, [])
    assert quality_rules(empty).collect() == []
    wordless = quality_rules(documents(spark, [(1, None, "en"), (2, "  ", None)])).collect()
    assert [(r.n_words, r.kept) for r in wordless] == [(0, False)] * 2


def test_words_are_hashed_once_and_common_ones_looked_up(spark, prose):
    """No step goes through all common words, or through five strings, for each word of a text."""
    judged = quality_rules(documents(spark, [(i, prose(200), "en") for i in range(40)]))
    plan = judged._jdf.queryExecution().optimizedPlan().toString()
    assert " INSET " in plan and "array_contains" not in plan
    assert plan.count("xxhash64(") == 4 and "regexp_extract_all" not in plan


def test_common_words_are_counted_in_any_case(spark, prose):
    """The divergence by plain counting, with words that share parts and words of other languages."""
    rows = [(i, prose(150).title() + " THE theth \u0130S \u039f\u03a3 der", "en") for i in range(30)]
    rows += [(100 + i, "der die das und " * 2 + prose(80).replace("the", "der"), "de") for i in range(30)]
    docs = documents(spark, rows)
    references = {r.lang: r for r in language_references(docs).collect()}
    assert set(references) == {"en", "de", None}

    def part(p, q):
        return sum(x * np.log2(2 * x / (p + q)) for x in (p, q) if x > 0) / 2

    found = {r.doc_id: r for r in quality_rules(docs).collect()}
    for i, text, lang in rows:
        if found[i].base_failed:
            continue
        counts = Counter(x.lower() for x in WORDS.findall(text))
        shares = [counts[w] / counts.total() for w in references[lang].words]
        expected = sum(part(p, q) for p, q in zip([*shares, 1 - sum(shares)], references[lang].word_p, strict=True))
        assert abs(found[i].word_divergence - expected) < 1e-9
    assert sum(not r.base_failed for r in found.values()) > 40


# ------------------------------------------------------------------------------ spelling variants


def one_edit(a, b):
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    short, long = sorted((a, b), key=len)
    return len(long) == len(short) + 1 and any(long[:i] + long[i + 1 :] == short for i in range(len(long)))


def plain_variants(counts):
    words = {w: n for w, n in counts.items() if len(w) >= 5 and n >= 3}
    near = {w: [v for v in words if one_edit(w, v)] for w in words}
    form = {}
    for w, others in near.items():
        best = min(others, key=lambda v: (-words[v], v), default=None)
        form[w] = best if best is not None and words[best] >= 2 * words[w] else None
    rows = set()
    for w in words:
        root = w
        while form[root] is not None:
            root = form[root]
        rows.add((w, form[w], root, words[w], len(near[w]), words.get(form[w])))
    return rows


def variants(spark, counts):
    frame = spark.createDataFrame(list(counts.items()), "word string, n long")
    return {tuple(r) for r in spelling.spelling_variants(frame).select("word", "form", "root", "n", "n_near", "form_n").collect()}


def random_words(rng, n, letters):
    words = {"".join(rng.choice(letters, rng.integers(4, 9))) for _ in range(n)}
    return {w: int(3 + 200 * rng.random() ** 4) - (rng.random() < 0.1) * 2 for w in words}


def test_variants_against_all_pairs(spark):
    rng = np.random.default_rng(4)
    counts = random_words(rng, 500, list("abcé")) | random_words(rng, 200, list("aiqyÿ"))
    counts |= {"x" * 300: 9, "x" * 299 + "y": 4, "x" * 301: 30, "é" * 140: 5, "é" * 141: 20, "é" * 142: 60}
    assert variants(spark, counts) == plain_variants(counts)


def test_variants_of_blocks_in_many_tiles(spark, monkeypatch):
    monkeypatch.setattr(spelling, "TILE_WORDS", 7)
    monkeypatch.setattr(spelling, "SLICE", 5)
    counts = random_words(np.random.default_rng(5), 300, list("ab"))
    assert variants(spark, counts) == plain_variants(counts)


def test_chains_of_forms_lead_to_one_root(spark):
    counts = {"a" * (6 + i): 3 * 2**i for i in range(40)}
    assert {r[2] for r in variants(spark, counts)} == {max(counts, key=counts.get)}


def test_no_words_no_variants(spark):
    assert variants(spark, {"abcd": 9, "abcde": 2}) == set()
    assert spelling.spelling_variants(spark.createDataFrame([], "word string, n long")).collect() == []


def test_words_of_odd_documents(spark):
    texts = [
        (1, "Über über ÜBER straße naïve ×÷ Ab12cd"), (None, "no id here"), (2, None), (2, ""),
        (3, "z" * 5000 + " z"), (4, "word word"), (4, "word word"),
    ]
    upper = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    expected = Counter()
    for i, text in texts * 30:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = run.translate(upper)
            h = zlib.crc32(f"{'' if i is None else i}:{run}".encode())
            expected[run[: h % len(run)] + run[h % len(run) + 1 :] if h % 5 == 0 else run] += 1
    docs = documents(spark, [(i, text, "en") for i, text in texts * 30])
    assert {r.word: r.n for r in spelling.corpus_words(docs, damaged=5).collect()} == expected


# ------------------------------------------------------------------------------ conversation repair


def lawful(initials):
    return re.fullmatch("(s?(ua)+)?", initials) is not None


def plain_faults(rows):
    seen, faults = set(), []
    for _, role, text in rows:
        if not WORDS.search(text):
            faults.append("blank")
        elif (role, text) in seen:
            faults.append("duplicate")
        else:
            faults.append(None if re.search(r"[.!?][\x20\x09-\x0D]*\Z", text) else "truncated")
        seen.add((role, text))
    return faults


def plain_repair(rows):
    """The least (cost, edits) by trying all edits, with up to two turns inserted in any place."""
    faults, best = plain_faults(rows), None
    inserts = ["", "I", "II"]
    for edits in itertools.product(*([("D",) if f in ("blank", "duplicate") else "KRD" for f in faults])):
        for gaps in itertools.product(inserts, repeat=len(rows) + 1):
            cost = 2 * sum(map(len, gaps)) + sum({"K": 0, "R": 2, "D": 3}[e] for e in edits)
            cost += sum(f == "truncated" and e != "D" for f, e in zip(faults, edits))
            audit = "".join(g + e for g, e in zip(gaps, (*edits, "")))
            if best and (cost, audit) >= best[:2]:
                continue
            free = [None] * len(gaps[0])
            for (_, role, _), edit, gap in zip(rows, edits, gaps[1:]):
                free += [] if edit == "D" else [role[:1] if edit == "K" else None]
                free += [None] * len(gap)
            for led in (False, True):
                wanted = ["s"] * led + ["u", "a"] * len(free)
                filled = "".join(x if x is not None else y for x, y in zip(free, wanted))
                if lawful(filled) and not (led and (not free or free[0] != "s")):
                    best = (cost, audit)
    return best


def plain_hash(rows, audit):
    lines, turns, last = [], iter(rows), ""
    for edit in audit:
        role, text = (None, "") if edit == "I" else next(turns)[1:]
        if edit == "D":
            continue
        if edit != "K":
            role = "assistant" if last == "u" else "user"
        last = role[:1]
        lines.append(f"{role}:{text}")
    return hashlib.sha256("\n".join(lines).encode()).hexdigest()


def plain_report(rows):
    rows = sorted(((t, r or " ", " " if x is None else x) for t, r, x in rows), key=lambda r: (r[0] is not None, r[0] or 0, r[1], hashlib.sha256(r[2].encode()).hexdigest()))
    known = [t for t, *_ in rows if t is not None]
    faults = plain_faults(rows)
    illegal = sum(a[1][:1] + b[1][:1] not in ("su", "ua", "au") for a, b in zip(rows, rows[1:]))
    cost, audit = plain_repair(rows)
    gaps = max(known) - min(known) + 1 - len(set(known)) if known else 0
    return (gaps, *(faults.count(x) for x in ("blank", "duplicate", "truncated")), illegal, cost, audit, plain_hash(rows, audit))


def conversations(spark, convs):
    rows = [(c, *row, 1, "z") for c, turns in convs.items() for row in turns]
    return spark.createDataFrame(rows, "conv_id long, turn long, role string, text string, conv int, audit string")


def report(spark, convs):
    rows = conversation_repair.Repairs(conversations(spark, convs)).report().collect()
    return {r.conv_id: tuple(r)[1:] for r in rows}


@pytest.fixture(scope="module")
def random_convs():
    rng = np.random.default_rng(6)
    roles = ["system", "user", "assistant", "tool", None]
    texts = ["Yes.", "No!", "and then", "", None, "What? \n", "one ."]
    convs = {}
    for c in range(60):
        turns = []
        for i in range(rng.integers(1, 5)):
            turn = None if rng.random() < 0.1 else int(i + rng.integers(0, 2))
            role = roles[rng.choice(5, p=[0.15, 0.35, 0.35, 0.1, 0.05])]
            turns.append((turn, role, texts[rng.integers(len(texts))]))
        convs[c] = turns
    convs[None] = [(1, "user", "Hi."), (1, "user", "Hi."), (2, "assistant", "Ho.")]
    return convs


def test_repairs_against_all_edits(spark, random_convs):
    assert report(spark, random_convs) == {c: plain_report(turns) for c, turns in random_convs.items()}


def test_chunked_conversations_are_repaired_alike(spark, random_convs, monkeypatch):
    long = {100 + k: [(i, "uasx"[(i * k) % 3] + "er", f"Text {i % (20 + k)}" + "." * (i % 5 > 0)) for i in range(50)] for k in range(4)}
    whole = report(spark, random_convs | long)
    monkeypatch.setattr(conversation_repair, "CHUNK", 3)
    assert report(spark, random_convs | long) == whole


def test_repaired_turns_follow_the_rules(spark, random_convs):
    frame = conversations(spark, random_convs)
    turns = conversation_repair.Repairs(frame).repaired().collect()
    audits = {r.conv_id: r.audit for r in conversation_repair.Repairs(frame).report().collect()}
    for c in random_convs:
        mine = sorted((r.place, r.role, r.text, r.edit) for r in turns if r.conv_id == c)
        assert [m[0] for m in mine] == list(range(1, len(mine) + 1))
        assert lawful("".join(m[1][:1] for m in mine))
        assert "".join(m[3] for m in mine) == audits[c].replace("D", "")


def test_very_long_turns_and_one_large_conversation(spark, monkeypatch):
    monkeypatch.setattr(conversation_repair, "CHUNK", 64)
    convs = {1: [(i, "user" if i % 2 else "assistant", f"{i} " + "word " * (100_000 if i == 5 else 1) + "end.") for i in range(1, 1001)]}
    assert report(spark, convs)[1][:7] == (0, 0, 0, 0, 0, 0, "K" * 1000)
    again = {1: [(i, "user", "the same.") for i in range(500)]}
    assert report(spark, again)[1][:6] == (0, 0, 499, 0, 499, 3 * 499 + 2)


def test_repair_of_nothing(spark):
    none = conversations(spark, {})
    assert conversation_repair.Repairs(none).report().collect() == []
    assert conversation_repair.Repairs(none).repaired().collect() == []
    assert conversation_repair.repair_report(none).collect() == []


def test_conversations_whose_rows_are_all_dropped(spark):
    gone = next(i for i in range(1000) if zlib.crc32(f"{i}:0".encode()) % 20 == 0)
    kept = next(i for i in range(1000) if zlib.crc32(f"{i}: ".encode()) % 20 > 4)
    frame = conversations(spark, {gone: [(0, "user", "Hi.")], kept: [(None, "user", "Hi.")]})
    rows = {r.conv_id: tuple(r)[1:] for r in conversation_repair.repair_report(frame).collect()}
    assert rows[gone] == (0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest())
    assert rows[kept][:7] == (0, 0, 0, 0, 0, 2, "KI")
