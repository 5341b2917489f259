"""Token alignment against a comparison of all token ranges."""

import hashlib
import random
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from litsieve.llm import token_alignment as ta
from litsieve.llm.common import public_tokenizer
from litsieve.llm.queries import op11_token_windows

FOLDER = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def encoders():
    import sentencepiece
    from tokenizers import Tokenizer

    a = Tokenizer.from_file(public_tokenizer(ta.BYTE_LEVEL_FILE))
    a.encode_special_tokens = True
    return a, sentencepiece.SentencePieceProcessor(model_file=public_tokenizer(ta.PIECE_FILE))


def ranges(ids, entries):
    at, out = 0, []
    for i in ids:
        out.append((i, at, at + len(entries[i])))
        at += len(entries[i])
    return out, at


def brute(texts, encoders):
    """Per text: sides, groups and links by comparing every pair of ranges."""
    byte_level, pieces = encoders
    a_entries, b_entries = ta.byte_level_tokens(public_tokenizer(ta.BYTE_LEVEL_FILE)), ta.piece_tokens(pieces)
    parts = []
    for text in texts:
        a_ids = byte_level.encode(" " + text, add_special_tokens=False).ids if text else []
        b_ids = pieces.encode(text) if text else []
        data = (" " + (text or "")).encode()
        if not text or b"".join(a_entries[i] for i in a_ids) != data or b"".join(b_entries[i] for i in b_ids) != data:
            parts.append(([], [], "", []))
            continue
        (a, _), (b, _) = ranges(a_ids, a_entries), ranges(b_ids, b_entries)
        ends = sorted({x[2] for x in a} & {x[2] for x in b})
        groups = []
        for low, high in zip([0, *ends], ends):
            inside = [",".join(str(i) for i, s, e in side if low <= s and e <= high) for side in (a, b)]
            groups.append("|".join(inside))
        links = [(i, j) for i, s, e in a for j, t, f in b if s < f and t < e]
        parts.append((a_ids, b_ids, ";".join(groups), links))
    counts = Counter(pair for *_, links in parts for pair in set(links))
    most = defaultdict(int)
    for (a, _), n in counts.items():
        most[a] = max(most[a], n)
    return [
        (
            len(a), len(b), len(g.split(";")) if g else 0, len(links), sum(counts[p] == most[p[0]] for p in links),
            sum(counts[p] for p in links), hashlib.sha256(g.encode()).hexdigest() if g else "",
        )
        for a, b, g, links in parts
    ]


def found(df):
    names = ["n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]
    return {r.doc_id: tuple(r[c] for c in names) for r in df.collect()}


TEXTS = [
    None, "", " ", "a", "Hello world, again and again.", "  two  spaces\n\nlines\t tabs ", "<|endoftext|> and </s><unk> inside",
    "naïve café İstanbul İ̇", "日本語のテキスト 混ぜて", "▁marks▁", "emoji 👩‍👩‍👧 end", "numbers 1234567 3.14", "don't we'll 'tis",
    "x" * 3000, " " * 500, "Hello world, again and again.", "\x00\x01 control\x7f", "trailing space ",
]


def test_groups_links_and_counts(spark, encoders, monkeypatch):
    rows = [(i, t) for i, t in enumerate(TEXTS)]
    df = spark.createDataFrame(rows, "doc_id long, text string").withColumns({"row": F.lit("clash"), "pairs": F.lit(1), "n": F.lit(2)})
    want = dict(enumerate(brute(TEXTS, encoders)))
    assert found(ta.token_alignment(df)) == want
    # All pairs through the join, and some.
    assert found(ta.token_alignment(df, head=0)) == want
    assert found(ta.token_alignment(df, head=40)) == want


def test_random_texts_small_memo_and_parts(encoders, monkeypatch):
    monkeypatch.setattr(ta, "MEMO_WINDOWS", 5)
    monkeypatch.setattr(ta, "PART_CHARS", 40)
    aligner = ta._Aligner(public_tokenizer(ta.BYTE_LEVEL_FILE), public_tokenizer(ta.PIECE_FILE))
    draw = random.Random(3)
    words = ["the", "of", "Zürich", "ab\n", "\t", "  ", "日本", "it's", "1999", "x_y", "é", "<s>", "...", "antidisestablishment", " "]
    texts = [draw.choice(["", " "]).join(draw.choice(words) + draw.choice([" ", " ", ""]) for _ in range(draw.randint(1, 60))) for _ in range(150)]
    for text, want in zip(texts, brute(texts, encoders)):
        a, b, groups, links, digest, pairs, times = aligner.align(text.encode())
        assert (a, b, groups, links, digest) == (*want[:4], want[6])
        assert sum(times) == links and len(set(pairs)) == len(pairs)


def test_repeated_rows_and_no_ids(spark, encoders):
    rows = [(1, "one two"), (1, "one two"), (None, "one two"), (None, None)]
    got = ta.token_alignment(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    want = brute([t for _, t in rows], encoders)
    assert sorted((r.n_links, r.count_sum) for r in got) == sorted((w[3], w[5]) for w in want)
    assert ta.token_alignment(spark.createDataFrame([], "doc_id long, text string")).count() == 0


def test_query(spark, encoders):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet").select("doc_id", "text").collect()
    got = found(op11_token_windows(spark, FOLDER))
    assert got == dict(zip([r.doc_id for r in docs], brute([r.text for r in docs], encoders)))


def test_long_text_and_word(encoders):
    aligner = ta._Aligner(public_tokenizer(ta.BYTE_LEVEL_FILE), public_tokenizer(ta.PIECE_FILE))
    text = "words of a very long text " * 100_000
    assert aligner.align(text.encode())[:2] == (len(encoders[0].encode(" " + text).ids), len(encoders[1].encode(text)))
    assert aligner.align(b"a" * 200_000)[0] > 0
