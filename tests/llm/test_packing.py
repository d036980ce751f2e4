import random

import numpy as np
import pyarrow.parquet as pq
from helpers import documents

from creditmart.llm import packing, queries


def slow_best_fit(lengths, length):
    rows, room = [], []
    for i in sorted(range(len(lengths)), key=lambda i: (-lengths[i], i)):
        fits = [r for r in range(len(rows)) if room[r] >= lengths[i]]
        if fits:
            r = min(fits, key=lambda r: room[r])
        else:
            r = len(rows)
            rows.append([])
            room.append(length)
        rows[r].append(i)
        room[r] -= lengths[i]
    return sorted(room)


def test_best_fit_against_search_of_all_rows():
    draw = random.Random(2)
    for length in (1, 7, 8, 100):
        for _ in range(60):
            lengths = [draw.randint(1, length) for _ in range(draw.randint(0, 60))]
            got = packing.best_fit(lengths, length)
            assert sorted(i for r in got for i in r) == list(range(len(lengths)))
            # which of equally full rows is taken is open; how full the rows get is not
            assert sorted(length - sum(lengths[i] for i in r) for r in got) == slow_best_fit(lengths, length)


def unpack(rows, length, width=2):
    """Token ids by document from packed rows."""
    parts = {}
    for r in rows:
        ids = np.frombuffer(r["ids"], f"<u{width}")
        assert len(ids) == length and r["cu_seqlens"][0] == 0 and len(r["cu_seqlens"]) == len(r["doc_ids"]) + 1
        assert (ids[r["cu_seqlens"][-1]:] == 50256).all()
        for d, s, a, b in zip(r["doc_ids"], r["segments"], r["cu_seqlens"], r["cu_seqlens"][1:]):
            parts.setdefault((d, s), []).append(ids[a:b].tolist())
    return parts


def test_files_hold_all_tokens(spark, small, tmp_path):
    docs = spark.read.parquet(f"{small}/documents.parquet")
    packing.write(packing.pack(docs, length=128, shard_bytes=100_000, run_size=300), str(tmp_path / "packed"))
    rows = pq.read_table(tmp_path / "packed").to_pylist()
    for r in rows:
        assert r["positions"] == [i for a, b in zip(r["cu_seqlens"], r["cu_seqlens"][1:]) for i in range(b - a)]
    parts = unpack(rows, 128)
    encode = packing.byte_pairs()[0]()
    for d in docs.collect():
        expected = [*encode(d.text), 50256]
        got = [t for s in range(-(-len(expected) // 128)) for t in parts.pop((d.doc_id, s))[0]]
        assert got == expected
    assert not parts
    used = sum(r["cu_seqlens"][-1] for r in rows)
    assert len({r["shard"] for r in rows}) > 2 and used / (128 * len(rows)) > 0.97


def test_query_is_the_same_on_other_partitions(spark, small):
    docs = spark.read.parquet(f"{small}/documents.parquet")
    one = sorted(map(str, queries.QUERIES["op9_token_packing"](spark, small).collect()))
    packed = packing.pack(docs.repartition(7)).selectExpr("shard", "run", "row", "sha2(ids, 256) as h").collect()
    assert len(one) == len(packed) and all(any(r.h in x for x in one) for r in packed)


def test_edges(spark):
    docs = documents(spark, [(1, None), (2, ""), (None, "hi"), (None, "hi"), (4, "a b " * 100_000), (5, "x"), (5, "x")])
    docs = docs.withColumnRenamed("lang", "ids").withColumnRenamed("source", "shard")
    parts = unpack(packing.pack(docs).collect(), packing.LENGTH)
    assert parts[1, 0] == parts[2, 0] == [[50256]] and len(parts[None, 0]) == len(parts[5, 0]) == 2
    encode = packing.byte_pairs()[0]()
    assert [t for s in range(len([p for p in parts if p[0] == 4])) for t in parts[4, s][0]] == [*encode("a b " * 100_000), 50256]
    assert packing.pack(docs.limit(0)).count() == 0


def test_ids_come_back_in_their_own_type(spark):
    """A null beside ids that no double holds, text ids, and one id in a third of all rows."""
    rows = [(2**60 + 1, "a b"), (None, "c"), (2**60 + 2, "d e"), (None, None), (None, None)]
    out = packing.pack(spark.createDataFrame(rows, "doc_id long, text string"))
    got = [i for r in out.collect() for i in r["doc_ids"]]
    assert sorted(got, key=str) == sorted((i for i, _ in rows), key=str) and out.schema["doc_ids"].dataType.simpleString() == "array<bigint>"
    out = packing.pack(spark.createDataFrame([("a", "x"), ("b", "y"), (None, "z")], "doc_id string, text string"))
    assert sorted((i for r in out.collect() for i in r["doc_ids"]), key=str) == [None, "a", "b"]


def test_a_hot_id_and_empty_rows_are_spread(spark):
    rows = [(7, f"text number {i}") for i in range(200)] + [(None, "")] * 200 + [(i, f"other {i}") for i in range(200)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    out = packing.pack(docs, shard_bytes=300, most_tasks=3)
    got = out.collect()
    shards = max(r["shard"] for r in got) + 1
    homes = {}
    for r in got:
        for i in r["doc_ids"]:
            homes.setdefault(i, set()).add(r["shard"])
    assert shards > 15 and len(homes[7]) > 10 and len(homes[None]) > 10
    assert out.rdd.getNumPartitions() == 3 and sum(len(r["doc_ids"]) for r in got) == 600


def test_rows_do_not_depend_on_the_number_of_tasks(spark, small):
    docs = spark.read.parquet(f"{small}/documents.parquet")
    one, many = (
        sorted((r["shard"], r["run"], r["row"], bytes(r["ids"])) for r in packing.pack(docs, shard_bytes=20_000, most_tasks=t).collect())
        for t in (1, 64))
    assert one == many
