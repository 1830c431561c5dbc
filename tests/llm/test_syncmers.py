import hashlib
import random
import re

import numpy as np
import xxhash
from pyspark.sql import functions as F

from marketlake.llm import syncmers
from marketlake.llm.syncmers import fingerprints

M = (1 << 64) - 1


def hash_longs(*values):  # as Spark's xxhash64 chains its columns
    seed = 42
    for v in values:
        seed = xxhash.xxh64_intdigest(int(v & M).to_bytes(8, "little"), seed)
    return seed - (1 << 64) if seed >> 63 else seed


def hash_text(text):
    return signed(xxhash.xxh64_intdigest(text.encode(), 42))


def signed(x):
    return x - (1 << 64) if x >> 63 else x


def sketch(text):
    """Hash to first position, of the anchors that a fingerprint keeps."""
    units = re.split("[\x20\x09-\x0d]+|(?<=[aeiouyAEIOUY0-9\u00c0-\U0010ffff])", text)
    found = {}
    if text and len(units) == 1:
        found[(hash_text(text) & M) >> 33] = 0
    elif text:
        units = [0] * 6 + [hash_text(u) for u in units]
        for i in range(len(units) - 5):
            four = [hash_longs(*units[i + j : i + j + 3]) for j in range(4)]
            if min(four) in (four[0], four[3]):
                found.setdefault((hash_longs(four[0], four[3]) & M) >> 33, i)
    least = sorted(found)
    return {h: found[h] for n, h in enumerate(least) if n < 64 or h < 2**27}


def like(a, b):
    complete = lambda s: 2**31 if len(s) < 64 else max(2**27, max(s) + 1)
    upto = min(complete(a), complete(b))
    low_a, low_b = ({h for h in s if h < upto} for s in (a, b))
    shifts = sorted(b[h] - a[h] for h in low_a & low_b)
    band = max([0, *a.values(), *b.values()]) / 8
    matching = sum(abs(d - shifts[len(shifts) // 2]) <= band for d in shifts)
    return matching / len(low_a | low_b) if low_a | low_b else 1.0


def brute_force(pairs):
    pairs = sorted(((d, t or "") for d, t in pairs), key=lambda p: (p[0] is not None, p[0] or 0, p[1].encode()))
    out = []
    for i, (doc, text) in enumerate(pairs):
        after = pairs[(i + 1) % len(pairs)][1]
        q = len(text) // 4
        edited = text[: len(text) - q] + after[:q]
        a, b, c = sketch(text), sketch(edited), sketch(after)
        hexed = lambda s: "".join(f"{h:08x}{s[h]:08x}" for h in sorted(s))
        out.append((doc, len(text), hashlib.sha256(edited.encode()).hexdigest(), hexed(a), hexed(b), like(a, b), like(a, c)))
    return sorted(out, key=repr)


def rows(df):
    return sorted(
        ((r.doc_id, r.n_chars, hashlib.sha256(r.edited.encode()).hexdigest(), r.fingerprint, r.edited_fingerprint, r.near_edited, r.near_next) for r in df.collect()),
        key=repr,
    )


def test_like_brute_force(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").repartition(5)
    wanted = brute_force([(r.doc_id, r.text) for r in docs.collect()])
    assert rows(fingerprints(docs)) == wanted
    assert all(w[5] > 0 for w in wanted if w[1] > 12)  # no text so short that nothing of it is found again
    long = [w for w in wanted if w[1] > 400]
    assert np.mean([w[5] for w in long]) > 0.5 and np.mean([w[6] for w in long]) < 0.2


def test_positions_count(spark, documents):
    rng = random.Random(3)
    p, q = ("".join(rng.choice("abcdefgh ") for _ in range(6000)) for _ in range(2))
    han = "".join(chr(0x4E00 + rng.randrange(3000)) for _ in range(540))
    texts = [p + q, q + p, "x" * 900 + q + p, han, han[:200] + "\U00020000" + han[200:], "eight words are enough for a short text", p * 3 + "".join(rng.choice("abcdefgh ") for _ in range(96000))]
    found = {r.doc_id: r for r in fingerprints(documents(list(enumerate(texts)))).collect()}
    assert 0.3 < found[0].near_next < 0.65  # passages in another order
    assert found[1].near_next > 0.85  # the same after an insertion
    assert found[3].near_next > 0.8 and found[3].near_edited > 0.5  # no spaces
    assert found[5].near_edited > 0.3
    assert 16 * 64 < len(found[0].fingerprint) < len(found[6].fingerprint) / 6  # grows with the text
    assert rows(fingerprints(documents(list(enumerate(texts))))) == brute_force(list(enumerate(texts)))


def test_odd_rows(spark, documents, odd):
    assert rows(fingerprints(documents(odd))) == brute_force(odd)
    assert rows(fingerprints(documents([(1, "one two three four five six")]))) == brute_force([(1, "one two three four five six")])
    assert fingerprints(documents([])).count() == 0


def test_edited_texts_have_the_sketch_of_their_whole_text(spark):
    """A new tail is looked at from the last unit of the head on, wherever the cut falls."""
    letters = ["a", "b", "k", "7", "E", " ", " ", "\t", "\x0b", " ", "é", "中", "😀"]
    dice = random.Random(3)
    texts = ["".join(dice.choice(letters) for _ in range(dice.choice([1, 2, 4, 5, 7, 8, 12, 20, 60, 400]))) for _ in range(300)]
    texts += ["bcdf", "bcdfg", "    ", "   x", "aaaa", "", "bbbb bbbb", "ba  ", " a  b  "]
    found = fingerprints(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string"))
    whole = syncmers.with_sketch(found, "edited", "sketch").withColumn("whole", syncmers.fingerprint(F.col("sketch")))
    assert whole.where("whole <> edited_fingerprint").count() == 0 and whole.count() == len(texts)
    # Only the new tail is cut into units: the tasks hash those of one text and a quarter, not of two.
    plan = found._jdf.queryExecution().optimizedPlan().toString()
    assert "split(edited" not in plan and "_head_sketch" in plan
