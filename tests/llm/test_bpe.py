import random

import pyarrow as pa
import public_tokenizers
import tiktoken
from hypothesis import given, settings
from hypothesis import strategies as st

from marketlake.llm.bpe import BatchEncoder, decode, encode
from marketlake.llm.kernels import utf8
from marketlake.llm.packing import byte_ranks, read_file

PATH = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
LIBRARY = tiktoken.Encoding(
    "own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=byte_ranks(read_file(PATH)), special_tokens={}
)
CODER = BatchEncoder(PATH)


def ids_of(texts):
    ids, bounds, starts, counts = CODER(*utf8(pa.array(texts, pa.string())))
    assert counts.sum() == len(ids)
    return [ids[a:b].tolist() for a, b in zip(bounds[:-1], bounds[1:])]


@settings(max_examples=200, deadline=None)
@given(st.lists(st.text(st.sampled_from("abstrevlmd' .,\n\t 12éñ漢ж😀\x1c\x85\xa0'") | st.characters(codec="utf-8")), max_size=8))
def test_any_text(texts):
    assert ids_of(texts) == [LIBRARY.encode_ordinary(t) for t in texts]


def test_repeated_letters():
    rng = random.Random(3)
    texts = ["".join(rng.choice("abth") for _ in range(rng.randrange(400))) for _ in range(300)]
    texts += ["a" * 5000, "th" * 3000, " " * 900, "'re" * 60, "", "ab" * 2000 + "'s"]
    assert ids_of(texts) == [LIBRARY.encode_ordinary(t) for t in texts]


def test_round_trip(spark, documents, odd):
    coded = encode(documents(odd), offsets=True)
    rows = coded.collect()
    texts = sorted((t or "" for _, t in odd))
    assert sorted(bytes(r.decoded).decode() for r in decode(coded.drop("slice_starts", "slice_ids")).collect()) == texts
    for row in rows:
        assert len(row.slice_starts) == len(row.slice_ids) and sum(row.slice_ids) == len(row.ids)
    assert encode(documents([])).count() == 0
