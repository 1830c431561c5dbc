import random
from collections import defaultdict

import numpy as np
import public_tokenizers
from tokenizers import Tokenizer

from marketlake.llm.packing import best_fit_decreasing, pack, pack_group


def check_rows(rows, docs, window=2048):
    library = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    library.encode_special_tokens = True
    wanted = sorted([*library.encode(text or "", add_special_tokens=False).ids, 1] for _, text in docs)
    by_doc, by_sequence = defaultdict(list), defaultdict(list)
    for r in rows:
        by_doc[r.doc_id].append(r)
        by_sequence[r.sequence_id].append(r)
        assert len(r.ids) == 4 * r.length
    found = []
    for pieces in by_doc.values():  # ids that stand twice have equal texts
        total = pieces[0].doc_tokens
        copies = sum(r.start == 0 for r in pieces)
        starts = sorted({(r.start, bytes(r.ids)) for r in pieces})
        if copies == 1:
            found.append(np.frombuffer(b"".join(x for _, x in starts), "<u4").tolist())
            assert sum(r.length for r in pieces) == total
        else:
            found += [np.frombuffer(b"".join(x for _, x in starts), "<u4").tolist()] * copies
    assert sorted(found) == wanted
    for pieces in by_sequence.values():
        at = 0
        for r in sorted(pieces, key=lambda r: r.offset):
            assert r.offset == at
            at += r.length
        assert at <= window
    return [sum(r.length for r in p) for p in by_sequence.values()]


def test_documents(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    rows = pack(docs).collect()
    fills = check_rows(rows, [(r.doc_id, r.text) for r in docs.collect()])
    padding = sum(0 if n & (n - 1) == 0 else 2048 - n for n in fills)
    assert padding < 0.005 * sum(fills)


def test_odd_rows(spark, documents, odd):
    check_rows(pack(documents(odd)).collect(), odd)
    assert pack(documents([])).count() == 0


def test_tightest_window():
    rng = random.Random(2)
    lengths = [rng.randint(1, 100) for _ in range(500)]
    rooms, wanted = [], []
    for size in sorted(lengths, reverse=True):  # a plain scan for the tightest window
        fits = [r for r in rooms if r >= size]
        if fits:
            rooms.remove(min(fits))
            rooms.append(min(fits) - size)
        else:
            rooms.append(100 - size)
    windows = best_fit_decreasing([(i, 0, n) for i, n in enumerate(lengths)], 100)
    assert sorted(100 - sum(p[2] for p in w) for w in windows) == sorted(rooms)


def test_groups_lose_nothing():
    rng = random.Random(4)
    for _ in range(50):
        lengths = [rng.choice((1, 5, 100, 150, rng.randint(1, 400))) for _ in range(rng.randint(0, 40))]
        parts = defaultdict(list)
        for w in pack_group(lengths, 100, 4):
            assert 0 < sum(p[2] for p in w) <= 100
            for doc, start, length in w:
                parts[doc].append((start, length))
        for doc, length in enumerate(lengths):
            at = 0
            for start, size in sorted(parts[doc]):
                assert start == at and size > 0
                at += size
            assert at == length


def test_added_tokens_as_the_library_reads_them(documents):
    library = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))  # with its default setting
    texts = ["a <|endoftext|> b", "<|endoftext|>", "x<|endoftext|><|endoftext|>\n\n y", "<|endoftext| > <|ENDOFTEXT|>", "plain  text", "  <|endoftext|>  é中"]
    texts += [f"one {c} two{c}" for c in (t.content for t in library.get_added_tokens_decoder().values())]
    rows = sorted(pack(documents(list(enumerate(texts)))).collect(), key=lambda r: r.start)
    for doc, text in enumerate(texts):
        wanted = [*library.encode(text, add_special_tokens=False).ids, 1]
        pieces = [r for r in rows if r.doc_id == doc]
        assert np.frombuffer(b"".join(bytes(r.ids) for r in pieces), "<u4").tolist() == wanted
        assert {r.doc_tokens for r in pieces} == {len(wanted)}
