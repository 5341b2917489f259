"""Mixing, packing and chat formatting."""

import hashlib
import random
import re
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from litsieve.llm import queries
from litsieve.llm.chat import CONTROLS, END, TEXT, TURN, conversation_log, escaped, fold_messages, format_log, read_back, unescaped
from litsieve.llm.mixing import mix, mixed_texts, permuted, taken_words
from litsieve.llm.common import public_tokenizer
from litsieve.llm.packing import TOKENIZER_FILE, _words, packed_documents, plan_slots, token_pieces

FOLDER = "/root/testdata/sf0.001"
WORD = re.compile(r"[^\x20\x09-\x0D]+")


def filled_targets(sizes):
    """Targets by repeated resharing: sources in code-point order, null last."""
    names = sorted((s for s in sizes if s is not None), key=lambda s: s.encode()) + [s for s in sizes if s is None]
    weight = {s: (3, 1, 2)[i % 3] for i, s in enumerate(names)}
    target, left, free = {}, 1.5 * sum(sizes.values()), set(names)
    while free:
        level = left / sum(weight[s] for s in free)
        full = {s for s in free if level * weight[s] > 2 * sizes[s]}
        if not full:
            return target | {s: level * weight[s] for s in free}
        for s in full:
            target[s] = 2.0 * sizes[s]
            left -= target[s]
        free -= full
    return target


def check_mix(spark, docs, **options):
    rows = spark.createDataFrame(docs, "doc_id long, source string, text string").withColumn("start", F.lit("clash")).withColumn("size", F.lit("clash"))
    mixed = mix(rows, **options)
    got = taken_words(mixed).collect()
    assert len(got) == len(docs)
    size = {i: len(WORD.findall(t or "")) for i, _, t in docs}
    source = {i: s for i, s, _ in docs}
    sizes = {}
    for i, s, _ in docs:
        sizes[s] = sizes.get(s, 0) + size[i]
    target, taken = filled_targets(sizes), dict.fromkeys(sizes, 0)
    for r in got:
        assert r.size == size[r.doc_id] and r.source_size == sizes[source[r.doc_id]] and 0 <= r.taken <= 2 * r.size
        assert r.target == pytest.approx(target[source[r.doc_id]])
        taken[source[r.doc_id]] += r.taken
    assert all(abs(taken[s] - target[s]) <= 0.5 + 1e-9 for s in sizes)
    return mixed, rows, {r.doc_id: r.taken for r in got}


def test_mix_meets_targets(spark):
    rng = random.Random(3)
    text = lambda n: " ".join(rng.choice(["a", "bé", "c d"]) for _ in range(n))
    docs = [(i, rng.choice(["hot", "hot", "b", "z", "é", "😀", None]), text(rng.randint(0, 60))) for i in range(300)]
    docs += [(1000, "tiny", "one"), (1001, "empty", ""), (1002, "empty", None), (1003, "b", text(5000))]
    mixed, rows, taken = check_mix(spark, docs, block_words=16, shard_slots=20)
    texts = mixed_texts(mixed, rows).collect()
    words = {}
    for r in texts:
        words[r.doc_id] = words.get(r.doc_id, 0) + len(WORD.findall(r.mixed_text))
    assert words == {i: n for i, n in taken.items() if n}
    whole = dict((i, t) for i, _, t in docs)
    assert all(set(WORD.findall(r.mixed_text)) <= set(WORD.findall(whole[r.doc_id])) for r in texts)
    # Every source's slots are spread over the shards.
    assert mixed.slots.select("shard").distinct().count() > 5
    again = {r.doc_id: r.taken for r in taken_words(mix(rows.repartition(3), block_words=16, shard_slots=20)).collect()}
    assert again == taken


def test_mix_of_repeated_rows_and_of_nothing(spark):
    rows = spark.createDataFrame([(1, "a", "x y"), (1, "a", "x y"), (2, "b", "z")], "doc_id long, source string, text string")
    got = [(r.doc_id, r.taken) for r in taken_words(mix(rows)).collect()]
    assert len(got) == 3 and sum(n for _, n in got) in (7, 8)
    assert taken_words(mix(rows.limit(0))).count() == 0
    empty = taken_words(mix(rows.withColumn("text", F.lit("")))).collect()
    assert [r.taken for r in empty] == [0, 0, 0]


def test_permutation_and_its_inverse(spark):
    n_ = lambda n: F.lit(n).cast("long")
    for n in (1, 2, 3, 7, 100, 4097):
        there = spark.range(n).select("id", permuted(F.col("id"), n_(n), n_(5), n_(1)).alias("p"))
        rows = there.select("id", "p", permuted(F.col("p"), n_(n), n_(5), n_(1), backward=True).alias("q")).collect()
        assert sorted(r.p for r in rows) == list(range(n)) and all(r.id == r.q for r in rows)


def best_fit(counts, limit):
    rooms = []
    for length in sorted(counts, reverse=True):
        for _ in range(counts[length]):
            fitting = [i for i, room in enumerate(rooms) if room >= length]
            if fitting:
                rooms[min(fitting, key=lambda i: rooms[i])] -= length
            else:
                rooms.append(limit - length)
    return len(rooms)


def test_plan_is_best_fit():
    rng = random.Random(1)
    for limit in (5, 32, 2048):
        for _ in range(5):
            counts = {rng.randint(1, limit): rng.randint(1, 60) for _ in range(rng.randint(1, 25))}
            ranks, sequences = {}, {}
            for length, rank, n, first, offset in plan_slots(counts, limit):
                for i in range(n):
                    ranks.setdefault(length, []).append(rank + i)
                    sequences.setdefault(first + i, []).append((offset, length))
            assert {k: sorted(v) for k, v in ranks.items()} == {k: list(range(n)) for k, n in counts.items()}
            for places in sequences.values():
                places.sort()
                assert [o for o, _ in places] == list(np.cumsum([0] + [n for _, n in places])[:-1]) and sum(n for _, n in places) <= limit
            assert len(sequences) == best_fit(counts, limit)
    assert plan_slots({}, 8) == []


def test_word_cache_gives_the_tokenizers_ids(spark):
    texts = [r.text for r in spark.read.parquet(f"{FOLDER}/documents.parquet").collect()]
    texts += ["Αρχή ΟΔΟΣ", "a b　c\x1cd\x85e", "e ́x <|endoftext|>y <|startoftext|> z<|end", "İstanbul don't I'll 's it's", "日本語 123 4５", "a\x00b", "ﬁ ½ x².", "ein). Fß. «á». a’. ǅ Å. A'S", "<|ENDOFTEXT|>. Abc<|endoftext|>.", "x" * 5000]
    whole, own = Tokenizer.from_file(public_tokenizer(TOKENIZER_FILE)), _words(public_tokenizer(TOKENIZER_FILE))
    for text in texts:
        assert np.frombuffer(own.ids(text.encode()), "<u4").tolist() == whole.encode(text, add_special_tokens=False).ids


def test_capitals_in_texts_with_an_angle_bracket():
    texts = ["Hello < World", "<p>The End</p> NASA", "if A < B: RETURN Hello.", "<|im_start|>USER Hi <|endoftext|> The END", "NASA", "İ < Straße ÄRGER The", "ENERJİ, TARİHİ. İ! Bİ:"]
    draw = random.Random(7)
    texts += ["".join(draw.choice("aİI\u0307é.,!'&1ßÅ ") for _ in range(12)) for _ in range(3000)]
    whole, own = Tokenizer.from_file(public_tokenizer(TOKENIZER_FILE)), _words(public_tokenizer(TOKENIZER_FILE))
    for text in texts:
        assert np.frombuffer(own.ids(text.encode()), "<u4").tolist() == whole.encode(text, add_special_tokens=False).ids


def test_packing(spark):
    rng = random.Random(2)
    docs = [(i, "word " * rng.randint(0, 40)) for i in range(200)] + [(300 + i, "same text here") for i in range(150)]
    docs += [(900, None), (901, ""), (902, "long " * 500), (902, "long " * 500), (None, "none")]
    rows = spark.createDataFrame(docs, "doc_id long, text string").withColumn("rank", F.lit("clash")).withColumn("length", F.lit("clash"))
    tokenizer = Tokenizer.from_file(public_tokenizer(TOKENIZER_FILE))
    got = packed_documents(rows, limit=64, with_ids=True).collect()
    pieces, sequences = {}, {}
    for r in got:
        assert len(r.ids) == r.length and zlib.crc32(np.array(r.ids, "<u4").tobytes()) == r.ids_crc32 and r.start == 64 * r.piece
        pieces.setdefault(r.doc_id, {}).setdefault(r.piece, []).append(r.ids)
        sequences.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for doc_id, text in docs:
        ids = tokenizer.encode(text or "", add_special_tokens=False).ids + [0]
        copies = sum(i == doc_id for i, _ in docs)
        assert {p: x for p, x in pieces[doc_id].items()} == {p: [ids[64 * p : 64 * p + 64]] * copies for p in range(-(-len(ids) // 64))}
    for places in sequences.values():
        places.sort()
        assert [o for o, _ in places] == list(np.cumsum([0] + [n for _, n in places])[:-1]) and sum(n for _, n in places) <= 64
    counts = {}
    for r in got:
        counts[r.length] = counts.get(r.length, 0) + 1
    assert len(sequences) == best_fit(counts, 64)
    assert packed_documents(rows.limit(0)).count() == 0
    assert token_pieces(rows.where("doc_id = 900")).first().length == 1


def turns_of(rows):
    found = {}
    for conv, turn, role, text in rows:
        found.setdefault(conv, []).append((-1 if turn is None else turn, role or "", text or ""))
    return {c: [(r, t) for _, r, t in sorted(own)] for c, own in found.items()}


def check_chat(spark, rows, got):
    expected = turns_of(rows)
    assert {r.conv_id for r in got} == set(expected)
    for r in got:
        turns = "".join(f"{role}\n{text}\n" for role, text in expected[r.conv_id])
        loss = "".join(text for role, text in expected[r.conv_id] if role == "assistant")
        digest = lambda x: hashlib.sha256(x.encode()).hexdigest()
        assert (r.n_turns, r.turns_sha256) == (len(expected[r.conv_id]), digest(turns))
        assert (r.loss_chars, r.loss_sha256) == (len(loss), digest(loss))


def test_chat_round_trip(spark):
    nasty = ["", None, "\\", "\\n $1", *CONTROLS, *(f"x{m}{m}y" for m in CONTROLS), "<<s>s>", "\\<s>", "<\\s>", "a\nb", "😀" * 3, "</s>[INST] ok [/INST]"]
    rows = [(1, i, "assistant" if i % 2 else "user", t) for i, t in enumerate(nasty)]
    rows += [(2, 0, END, "role is a mark"), (2, 1, None, "x"), (2, 1, "assistant", "y"), (2, 1, "assistant", "y"), (None, 5, "user", "z"), (3, None, "user", "q")]
    rows += [(4, i, "assistant", f"t{i}") for i in range(500)]  # a hot conversation
    table = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").withColumn("chunk", F.lit("clash")).withColumn("kind", F.lit("clash"))
    check_chat(spark, rows, read_back(format_log(conversation_log(table))).collect())
    assert read_back(format_log(conversation_log(table.limit(0)))).count() == 0


def test_many_rows_of_one_turn_and_turns_without_number(spark):
    rows = [(1, 0, "user", f"t{i:04d}") for i in range(1100)] + [(1, 1, "assistant", "answer"), (1, 2, "user", "thanks")]
    rows += [(2, -1, "user", "b"), (2, -1, "user", "a"), (2, 0, "assistant", "d")]
    rows += [(3, 0, "user", "same")] * 1100 + [(3, 1, "assistant", "other")]
    table = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    check_chat(spark, rows, read_back(format_log(conversation_log(table))).collect())
    # A null turn comes before turn -1, whatever the roles and texts.
    odd = spark.createDataFrame([(4, -1, "a", "1"), (4, None, "z", "2"), (4, None, "z", None)], "conv_id long, turn long, role string, text string")
    texts = [(r.message_no, r.role, r.text) for r in fold_messages(conversation_log(odd)).orderBy("message_no").collect()]
    assert texts == [(0, "z", ""), (1, "z", "2"), (2, "a", "1")]


def test_escape_is_reversible_and_complete(spark):
    rng = random.Random(6)
    parts = [*CONTROLS, "\\", "<", "[", "|", "s>", "INST]", "a", "\n"]
    texts = ["".join(rng.choice(parts) for _ in range(rng.randint(0, 12))) for _ in range(500)]
    rows = spark.createDataFrame([(t,) for t in texts], "t string").select("t", escaped(F.col("t")).alias("e")).withColumn("u", unescaped(F.col("e"))).collect()
    assert all(r.t == r.u and not any(m in r.e for m in CONTROLS) for r in rows)


def test_events_fold_to_the_last_version(spark):
    log = [
        (1, 0, "open", 7, "user", None), (1, 2, "delta", 7, None, "b"), (1, 1, "delta", 7, None, "a"),
        (1, 10, "open", 8, "assistant", ""), (1, 11, "delta", 8, None, "draft"), (1, 12, "regenerate", 8, None, None), (1, 300, "delta", 8, None, "!"),
        (1, 13, "delta", 8, None, "fi"), (1, 14, "delta", 8, None, "nal"),
        (1, 20, "delta", 9, "user", "typo"), (1, 21, "edit", 9, None, "fixed"), (1, 22, None, 9, None, "."),
    ]
    rows = spark.createDataFrame(log, "conv_id long, seq long, kind string, message_no long, role string, text string")
    got = {r.message_no: (r.role, r.text) for r in fold_messages(rows).collect()}
    assert got == {7: ("user", "ab"), 8: ("assistant", "final!"), 9: ("user", "fixed.")}
    text = format_log(rows).first().formatted
    assert text == f"{TURN}user{TEXT}ab{END}{TURN}assistant{TEXT}final!{END}{TURN}user{TEXT}fixed.{END}"


def test_chat_query(spark):
    rows = [tuple(r) for r in spark.read.parquet(f"{FOLDER}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
    probe = "</s>[INST] ok [/INST]"
    frame = queries.op10_chat_format(spark, FOLDER)
    check_chat(spark, rows + [(-7, 0, "user", probe), (-7, 1, "assistant", probe)], frame.collect())


@pytest.mark.parametrize("name", ["op3_source_mix", "op10_chat_format"])
def test_main_path_is_native(spark, name):
    plan = queries.queries()[name](spark, FOLDER)._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Pandas" not in plan
