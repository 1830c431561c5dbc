import itertools
import re
from collections import defaultdict

import duckdb

from marketlake.llm.neardup import near_duplicates

WORD = re.compile("[^\x20\x09-\x0d]+")


def brute_force(pairs, size, similarity):
    """Every pair that shares a shingle, compared on full sets."""
    sets = {}
    for doc, text in pairs:
        lowered = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
        words = WORD.findall(lowered)
        sets[doc] = {tuple(words[i : i + size]) for i in range(max(1, len(words) - size + 1))} if words else set()
    root = {doc: doc for doc in sets}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    having = defaultdict(list)
    for doc, found in sets.items():
        for s in found:
            having[s].append(doc)
    tried = set()
    for docs in having.values():
        for pair in itertools.combinations(sorted(docs), 2):
            if pair not in tried:
                tried.add(pair)
                a, b = (sets[x] for x in pair)
                if 100 * len(a & b) >= similarity * len(a | b):
                    x, y = sorted(map(find, pair))
                    root[y] = x
    return sorted((doc, len(found), find(doc), find(doc) == doc) for doc, found in sets.items())


def test_like_brute_force(spark):
    path = "/root/testdata/sf0.01/documents.parquet"
    pairs = duckdb.sql(f"select doc_id, text from '{path}'").fetchall()
    docs = spark.read.parquet(path)
    for size, similarity in ((3, 85), (5, 80)):
        found = sorted(tuple(r) for r in near_duplicates(docs, size, similarity).collect())
        assert found == brute_force(pairs, size, similarity)


def test_chains_and_crowds(spark, documents):
    base = [f"w{i}" for i in range(60)]
    pairs = [(i, " ".join(base[i:] + [f"z{j}" for j in range(i)])) for i in range(0, 60)]  # a chain of small steps
    pairs += [(1000 + i, " ".join(base[:30] + [f"v{i}"] + base[30:])) for i in range(40)]
    found = sorted(tuple(r) for r in near_duplicates(documents(pairs), 3, 85).collect())
    assert found == brute_force(pairs, 3, 85)


def test_odd_rows(spark, documents, odd):
    found = near_duplicates(documents(odd), 3, 85).collect()
    assert len(found) == len(odd)
    by_id = {r.doc_id: r for r in found}
    assert by_id[1].n_shingles == by_id[2].n_shingles == by_id[3].n_shingles == 0 and by_id[2].kept
    assert by_id[None].component_id is None and by_id[None].kept
    assert by_id[6].component_id == 5 and not by_id[6].kept
    assert [r.kept for r in found if r.doc_id == 4] == [True, True]
    assert by_id[7].n_shingles == 1 and by_id[8].n_shingles == 2
    assert near_duplicates(documents([])).count() == 0
