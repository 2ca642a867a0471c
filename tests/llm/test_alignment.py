import hashlib
import random
from collections import Counter, defaultdict

import public_tokenizers
import pytest
import sentencepiece
from tokenizers import Tokenizer

from tierlake.llm.alignment import _faster, align_tokenizers
from tierlake.llm.packing import _byte_of
from tierlake.llm.queries import CHECKS

A, B = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")
TEXTS = [
    "Hello world, hello tokenizers.", "", None, "a", " ", "  two  spaces ", "tabs\tand\nlines\r\n", "<|endoftext|> and <s> </s>",
    "naïve café — „quoted“ …", "日本語のテキスト", "😀😀 emoji 🏳️‍🌈", "x▁y", "<0x41>", "1234567 89", "  odd　spaces  ",
    "Hello world, hello tokenizers.", "the the the the", "\x00\x01\x7f", "ａｂｃ ﬁ", "a" * 500,
]


def brute(texts):
    a_tool, b_tool = Tokenizer.from_file(A), sentencepiece.SentencePieceProcessor(model_file=B)
    a_tool.encode_special_tokens = True
    byte_of, held, counts = _byte_of(), [], Counter()
    for text in texts:
        a, b, wanted = [], [], (" " + (text or "")).encode()
        if text:
            a = [(i, bytes(byte_of[c] for c in a_tool.id_to_token(i))) for i in a_tool.encode(" " + text, add_special_tokens=False).ids]
            for i in b_tool.encode(text):
                piece = b_tool.id_to_piece(i)
                b.append((i, bytes([int(piece[3:-1], 16)]) if b_tool.is_byte(i) else piece.replace("▁", " ").encode()))
            if b"".join(t for _, t in a) != wanted or b"".join(t for _, t in b) != wanted:
                a = b = []

        def placed(tokens):
            low = 0
            for i, t in tokens:
                yield i, low, low + len(t)
                low += len(t)
        a, b = list(placed(a)), list(placed(b))
        links = [(i, j) for i, s, e in a for j, t, f in b if s < f and t < e]
        common = sorted({e for _, _, e in a} & {f for _, _, f in b})
        groups, low = [], 0
        for end in common:
            groups.append(",".join(str(i) for i, s, e in a if low < e <= end) + "|" + ",".join(str(j) for j, t, f in b if low < f <= end))
            low = end
        counts.update(set(links))
        held.append((len(a), len(b), links, groups))
    highest = defaultdict(int)
    for (i, _), n in counts.items():
        highest[i] = max(highest[i], n)
    return [(na, nb, len(groups), len(links), sum(counts[p] == highest[p[0]] for p in links), sum(counts[p] for p in links),
             hashlib.sha256(";".join(groups).encode()).hexdigest() if groups else "") for na, nb, links, groups in held]


def rows_of(frame):
    return sorted(map(tuple, frame.select("id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256").collect()), key=repr)


@pytest.mark.parametrize("limit", [1 << 20, 0])
def test_against_all_overlapping_pairs(spark, limit):
    docs = spark.createDataFrame([(i, t, 1) for i, t in enumerate(TEXTS)], "doc_id long, text string, a int").repartition(3)
    rows, pairs = align_tokenizers(docs, A, B, broadcast_bytes=limit)
    assert rows_of(rows) == sorted(((i, *r) for i, r in enumerate(brute(TEXTS))), key=repr)
    assert pairs.columns == ["a", "b", "n", "best"] and pairs.filter("best").count() > 0


def test_slices_and_odd_texts(spark, monkeypatch):
    import tierlake.llm.alignment as module
    chance = random.Random(2)
    letters = ["a", "b", "é", " ", "  ", "\n", "日", "'s", "1", "<s>", "́", ".", "_", "\t"]
    texts = ["".join(chance.choice(letters) for _ in range(chance.randrange(0, 60))) for _ in range(120)]
    texts[50] = texts[51]
    monkeypatch.setattr(module, "SLICE_BYTES", 200)
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(2)
    assert rows_of(align_tokenizers(docs, A, B)[0]) == sorted(((i, *r) for i, r in enumerate(brute(texts))), key=repr)


def test_the_faster_encoder_gives_the_same_ids():
    tool, chance = Tokenizer.from_file(A), random.Random(3)
    tool.encode_special_tokens = True
    letters = [" ", "\t", "\n", "\x0b", "\x1c", "\x85", " ", " ", " ", "　", "​", "a", "É", "1", "²", "'", "ll", "日", "퟿", "😀", "<|endoftext|>"]
    for _ in range(3000):
        text = " " + "".join(chance.choice(letters) for _ in range(12))
        assert _faster(A).encode_ordinary(text) == tool.encode(text, add_special_tokens=False).ids, repr(text)


def test_empty_table_and_null_ids(spark):
    docs = spark.createDataFrame([], "doc_id long, text string")
    assert align_tokenizers(docs, A, B)[0].collect() == []
    docs = spark.createDataFrame([(None, "a b"), (None, "a b"), (1, None)], "doc_id long, text string")
    assert [r[1:4] for r in rows_of(align_tokenizers(docs, A, B)[0])] == [(0, 0, 0), (2, 2, 2), (2, 2, 2)]


def test_query_has_a_row_for_each_document(spark, tables):
    found = CHECKS["op12_tokenizer_alignment"].run(spark, tables)
    assert found.count() == spark.read.parquet(f"{tables}/documents.parquet").count()
