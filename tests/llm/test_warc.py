import base64
import hashlib
import os

import pytest

from kilowatt.llm import warc
from kilowatt.session import scratch_path


def expected(rows, least=0):
    first = {}
    for page, _, html in rows:
        h = (html or "").encode()
        if len(h) >= least and page is not None:
            first[h] = min(page, first.get(h, page))
    out = []
    for page, url, html in rows:
        h = (html or "").encode()
        ref = first.get(h) if first.get(h) != page else None
        out.append((page, len(h), base64.b32encode(hashlib.sha1(h).digest()).decode(), "response" if ref is None else "revisit", ref))
    return sorted(out, key=str)


def got(df):
    return sorted((tuple(r) for r in df.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to").collect()), key=str)


def files(folder):
    base = folder.removeprefix("file:")
    return {n: open(os.path.join(base, n), "rb").read() for n in sorted(os.listdir(base)) if n.endswith(".gz")}


ODD = [(1, "http://a", "<p>é</p>"), (2, "http://b", "<p>é</p>"), (3, None, None), (4, "http://c\r\nX: y", ""), (5, "http://d", "x" * 300_000),
       (6, "http://e", "x" * 300_000), (None, "http://f", "<p>é</p>"), (7, "http://g", "a\r\n\r\nb"), (8, "h", "alone"), (8, "h", "alone"), (9, "h", "alone"), (10, "i", "🙂 \x00")]


@pytest.mark.parametrize("least", [0, 7])
def test_odd_rows_round_trip(spark, least):
    pages = spark.createDataFrame([(*r, 1, "z") for r in ODD], "page_id long, url string, html string, shard int, tie string")
    folder = scratch_path(spark, "warc-test")
    manifest = warc.write_archives(pages, folder, least_bytes=least)
    assert got(warc.read_archives(spark, folder)) == expected(ODD, least)
    back = {(r["page_id"], r["payload"]) for r in warc.read_archives(spark, folder).collect() if r["record_type"] == "response"}
    assert (5, b"x" * 300_000) in {(a, bytes(b)) for a, b in back}
    assert {r["name"]: r["sha256"] for r in manifest.collect()} == {n: hashlib.sha256(b).hexdigest() for n, b in files(folder).items()}
    assert not os.path.exists(folder.removeprefix("file:") + "/_temporary")


def test_pages_round_trip_in_many_shards_and_files(spark, sf):
    pages = spark.read.parquet(f"{sf}/pages.parquet")
    rows = [(r["page_id"], r["url"], r["html"]) for r in pages.collect()]
    seen = []
    for part in (1, 9):
        folder = scratch_path(spark, "warc-test")
        manifest = warc.write_archives(pages.repartition(part), folder, roll_bytes=20_000, shard_bytes=60_000).collect()
        assert got(warc.read_archives(spark, folder, payloads=False)) == expected(rows)
        assert len({r["shard"] for r in manifest}) > 2 and max(r["file"] for r in manifest) > 0
        assert all(r["bytes"] <= 20_000 or r["records"] == 1 for r in manifest)
        seen.append(files(folder))
    assert seen[0] == seen[1]  # byte for byte, however the rows come


def test_records_are_sorted_and_one_gzip_member_each(spark, sf):
    folder = scratch_path(spark, "warc-test")
    warc.write_archives(spark.read.parquet(f"{sf}/pages.parquet"), folder, shard_bytes=60_000)
    ids = [warc.parse(m)["page_id"] for data in files(folder).values() for m in warc.members(iter([data[:1000], data[1000:]]))]
    assert ids == sorted(ids)


def test_hot_id_is_split(spark):
    rows = [(7, "u", f"page {i} " * 50) for i in range(400)]
    folder = scratch_path(spark, "warc-test")
    manifest = warc.write_archives(spark.createDataFrame(rows, "page_id long, url string, html string"), folder, shard_bytes=20_000).collect()
    assert len(manifest) > 4 and max(r["records"] for r in manifest) < 200
    assert got(warc.read_archives(spark, folder)) == expected(rows)


def test_damage_is_found():
    member = warc.record("response", 1, "http://a", b"payload", None, "1970-01-01T00:00:00Z")
    raw = next(warc.members(iter([member])))
    assert warc.parse(raw)["payload"] == b"payload"
    with pytest.raises(ValueError):
        warc.parse(raw.replace(b"payload", b"paxload"))
    with pytest.raises(ValueError):
        list(warc.members(iter([member[:-9]])))


def test_commit_can_be_repeated(spark):
    folder = scratch_path(spark, "warc-test")
    manifest = warc.write_archives(spark.createDataFrame(ODD[:3], "page_id long, url string, html string"), folder)
    before = files(folder)
    warc._commit(manifest, folder)
    assert files(folder) == before


def test_no_rows(spark):
    folder = scratch_path(spark, "warc-test")
    assert warc.write_archives(spark.createDataFrame([], "page_id long, url string, html string"), folder).count() == 0
    assert warc.read_archives(spark, folder).count() == 0
