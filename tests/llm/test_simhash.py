import random

import pytest
import xxhash
from helpers import Sets, documents

from creditmart.llm import queries, simhash
from creditmart.llm.components import components


def slow_fingerprint(text):
    low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    words = [w for w in __import__("re").split(r"[\x20\x09-\x0D]+", low) if w]
    if not words:
        return 0
    shingles = [" ".join(words[i : i + 3]) for i in range(max(1, len(words) - 2))]
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def slow_components(prints):
    """prints: list of (doc_id, fingerprint)."""
    sets = Sets()
    distinct = sorted({f for _, f in prints})
    for i, a in enumerate(distinct):
        sets.root(a)
        for b in distinct[:i]:
            if (a ^ b).bit_count() <= 2:
                sets.join(a, b)
    least = {}
    for d, f in prints:
        if d is not None:
            r = sets.root(f)
            least[r] = min(least.get(r, d), d)
    return {(d, f): least.get(sets.root(f)) for d, f in prints}


def test_fingerprint_and_edge_cases():
    for text in (None, "", " \n", "one", "One two", "a b c d", "É b c d\te", "x " * 1000, "A b c " * 70000):
        assert simhash.fingerprint(None if text is None else text.encode()) % (1 << 64) == slow_fingerprint(text)


@pytest.mark.parametrize("most_list", [simhash.LIST, 1, 3])
def test_components_against_all_pairs(spark, small, most_list):
    docs = spark.read.parquet(f"{small}/documents.parquet")
    rows = docs.select("doc_id", "text").collect()
    expected = slow_components([(r.doc_id, slow_fingerprint(r.text)) for r in rows])
    got = simhash.near_duplicates(docs, most_list=most_list).collect()
    assert {(r.doc_id, r.fingerprint % (1 << 64)): r.component_id for r in got} == expected and len(got) == len(rows)


def test_links_of_crowded_lists(spark):
    """Chains and a dense ball around one value, with and without crowding."""
    draw = random.Random(5)
    base = draw.getrandbits(64)
    values = {base}
    for _ in range(150):
        x = draw.choice(sorted(values))
        values.add(x ^ sum(1 << b for b in draw.sample(range(64), draw.choice([1, 2, 2, 3, 4]))))
    values |= {draw.getrandbits(64) for _ in range(50)}
    signed = [(simhash._signed(v),) for v in values]
    expected = slow_components([(v, v) for v in values])
    for most_list in (2, 32):
        links = simhash._links(spark.createDataFrame(signed, "f long"), most_list)
        got = {r.node % (1 << 64): r.component for r in components(links).collect()}
        classes = {}
        for v, c in got.items():
            classes.setdefault(c, set()).add(v)
        wanted = {}
        for (v, _), c in expected.items():
            wanted.setdefault(c, set()).add(v)
        assert sorted(map(sorted, classes.values())) == sorted(sorted(s) for s in wanted.values() if len(s) > 1)


def test_nulls_repeats_and_empty(spark):
    docs = documents(spark, [(5, ""), (3, None), (None, " "), (7, "a b c d"), (7, "a b c d"), (None, "q r s t u")])
    got = simhash.near_duplicates(docs).collect()
    assert sorted(str((r.doc_id, r.component_id)) for r in got) == sorted(map(str, [
        (5, 3), (3, 3), (None, 3), (7, 7), (7, 7), (None, None)]))
    kept = simhash.keep_one(docs).collect()
    assert sorted(str(r.doc_id) for r in kept) == ["3", "7", "None", "None"]
    assert simhash.near_duplicates(docs.limit(0)).count() == 0
    assert simhash.keep_one(docs.limit(0)).columns == docs.columns


def test_query(spark, small):
    rows = queries.QUERIES["op2_simhash"](spark, small).collect()
    assert all(len(r.fingerprint) == 16 for r in rows) and all(r.component_id <= r.doc_id for r in rows)
