import hashlib
import random

import pyarrow.fs as pafs
import pytest

from gridpanel.llm import warc
from gridpanel.session import scratch_path

SCHEMA = "page_id bigint, url string, html string, shard int, digest string, kind int"


def pages(spark, rows):
    return spark.createDataFrame([(*r, 9, "d", 8) for r in rows], SCHEMA)


def rows(seed=0):
    r = random.Random(seed)
    long_ = ["é" * 60 + str(i) for i in range(4)]
    out = [(i, f"http://x/{i}", r.choice(long_ + ["short", "", None, "z" * 100, "z" * 99])) for i in range(300)]
    return out + [(5, "http://again/", out[5][2]), (None, None, long_[0]), (1000, None, "q" * 300_000),
                  (1001, "http://a b\r\nX: 1", "x\r\n\r\nWARC/1.1\r\n" * 20)]


def expected(data):
    first = {}
    for i, _, h in data:
        b = (h or "").encode()
        if len(b) >= 100 and i is not None:
            first[b] = min(i, first.get(b, i))
    out = []
    for i, _, h in data:
        b = (h or "").encode()
        to = first.get(b)
        to = None if to is None or to == i else to
        out.append((i, len(b), hashlib.sha256(b).hexdigest(), "revisit" if to is not None else "response", to))
    return sorted(out, key=str)


@pytest.mark.parametrize("shard, size", [(1 << 24, 1 << 26), (4000, 700)])
def test_round_trip(spark, shard, size):
    data, out = rows(), scratch_path(spark, "warc-test")
    made = warc.write_warc(pages(spark, data), out, shard_bytes=shard, file_bytes=size).collect()
    got = warc.read_warc(spark, out, payloads=True).collect()
    assert sorted((tuple(r)[:1] + tuple(r)[2:6] for r in got), key=str) == expected(data)
    assert sorted(r.payload.decode() for r in got if r.payload is not None) == sorted(
        (h or "") for (i, _, h), e in zip(sorted(data, key=lambda x: str((x[0], len((x[2] or "").encode()), hashlib.sha256((x[2] or "").encode()).hexdigest()))), expected(data)) if e[3] == "response")
    fs, path = pafs.FileSystem.from_uri(out)
    names = {f.base_name: f.size for f in fs.get_file_info(pafs.FileSelector(path)) if f.base_name.startswith("part-")}
    assert names == {r.name: r.bytes for r in made}
    assert fs.get_file_info(f"{path}/_temporary").type == pafs.FileType.NotFound
    for r in made:
        with fs.open_input_stream(f"{path}/{r.name}", compression=None) as f:
            assert hashlib.sha256(f.read()).hexdigest() == r.sha256


def test_same_table_same_bytes_whatever_its_partitions(spark):
    data = rows(1)
    sums = []
    for n in (1, 7):
        out = scratch_path(spark, "warc-test")
        made = warc.write_warc(pages(spark, data[::-1] if n > 1 else data).repartition(n), out, shard_bytes=4000)
        sums.append(sorted((r.name, r.sha256) for r in made.collect()))
    assert sums[0] == sums[1] and len(sums[0]) > 3


def test_ids_are_in_order_within_and_across_shards(spark):
    out = scratch_path(spark, "warc-test")
    warc.write_warc(pages(spark, [(i, "u", "p" * 50) for i in range(500, 0, -1)]), out, shard_bytes=3000)
    fs, path = pafs.FileSystem.from_uri(out)
    ids = []
    for name in sorted(f.base_name for f in fs.get_file_info(pafs.FileSelector(path)) if f.base_name.startswith("part-")):
        with fs.open_input_stream(f"{path}/{name}", compression=None) as f:
            ids += [int(p["x-page-id"]) for p in map(warc.parse, warc.members(f, chunk=37)) if "x-page-id" in p]
    assert ids == sorted(ids) and len(ids) == 500


def test_commit_may_be_repeated_and_ignores_lost_attempts(spark):
    out = scratch_path(spark, "warc-test")
    fs, path = pafs.FileSystem.from_uri(out)
    fs.create_dir(f"{path}/_temporary", recursive=True)
    for name in ("a", "lost"):
        with fs.open_output_stream(f"{path}/_temporary/{name}") as f:
            f.write(warc.member(warc.warcinfo("x", "2000-01-01T00:00:00Z"), 6))
    size = fs.get_file_info(f"{path}/_temporary/a").size
    made = spark.createDataFrame([(0, 0, "_temporary/a", "part-0", 0, size, "s")], warc.MANIFEST)
    for _ in range(2):
        assert [r.name for r in warc.commit(made, out).collect()] == ["part-0"]
    assert warc.read_warc(spark, out).count() == 0


def test_empty_table(spark):
    out = scratch_path(spark, "warc-test")
    assert warc.write_warc(pages(spark, []), out).count() == 0
    assert warc.read_warc(spark, out).count() == 0
