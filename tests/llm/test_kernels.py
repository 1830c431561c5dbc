import random

import numpy as np
import public_tokenizers
import pytest
import tiktoken
from pyspark.sql import functions as F

from marketlake.llm import bpe, kernels, neardup
from marketlake.llm.packing import byte_ranks, read_file


def thue_morse(n):
    return "".join("ab"[bin(i).count("1") % 2] for i in range(n))


def complement(text):
    return text.translate(str.maketrans("ab", "ba"))


@pytest.mark.parametrize("segment", [50, 1 << 21])
def test_hashes_like_a_plain_polynomial(monkeypatch, segment):
    monkeypatch.setattr(kernels, "SEGMENT", segment)
    rng = random.Random(1)
    words = [bytes(rng.randrange(256) for _ in range(rng.choice((1, 2, 7, 300)))) for _ in range(200)]
    words += words[:50]
    data = np.frombuffer(b"".join(words), np.uint8)
    ends = np.cumsum([len(w) for w in words])
    starts = ends - [len(w) for w in words]
    found = kernels.PrimeHasher()(data, starts, ends)

    def plain(word):
        halves = [sum((b + 1) * pow(base, i, p) for i, b in enumerate(word)) % p for p, base in zip(kernels.PRIMES, kernels.BASES)]
        both = kernels.mix(np.array([halves[0] | halves[1] << 31], np.uint64))
        return int((both ^ (kernels.mix(np.array([len(word)], np.uint64)) >> np.uint64(1)))[0])

    assert found.tolist() == [plain(w) for w in words]
    assert len(set(found.tolist())) == len(set(words))


@pytest.mark.parametrize("n", [1024, 4096])
def test_words_that_fool_sums_modulo_powers_of_two(documents, n):
    a = thue_morse(n)
    texts = [(1, a), (2, complement(a)), (3, f"{a} x"), (4, f"{complement(a)} x"), (5, a)]
    docs = documents(texts).select("doc_id", "text")
    found = {r.doc_id: r for r in neardup.near_duplicates(docs, 3, 85).collect()}
    assert {d: r.component_id for d, r in found.items()} == {1: 1, 2: 2, 3: 3, 4: 4, 5: 1}
    ranks = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
    library = tiktoken.Encoding("t", pat_str=public_tokenizers.PATTERN, mergeable_ranks=byte_ranks(read_file(ranks)), special_tokens={})
    ids = {r.doc_id: list(r.ids) for r in bpe.encode(docs).collect()}
    assert ids == {d: library.encode_ordinary(t) for d, t in texts}
    made = bpe.encode(docs).select("doc_id", F.sha2(F.array_join("ids", ","), 256).alias("h")).collect()
    assert len({r.h for r in made}) == 4
