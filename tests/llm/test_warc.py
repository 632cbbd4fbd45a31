"""Archives: round trips, revisits, rolled files, leftovers of failed attempts."""

import glob
import gzip
import hashlib

import pytest

from candlewright.llm import warc

SCHEMA = "page_id long, url string, html string, tag int, file string"


def write(spark, rows, folder, **options):
    return warc.write_archive(spark.createDataFrame([(*r, 9, "f") for r in rows], SCHEMA).repartition(3), str(folder), **options)


BIG = "é<p>" * 40
ROWS = [(5, "http://a/5", BIG), (3, "http://a/3", BIG), (9, None, BIG), (1, "http://a b\r\nX: y/", "small"), (2, "", "small"), (4, "u", None), (6, "u", ""),
        (7, "u", "x" * 99), (8, "u", "x" * 99), (10, "u", "y" * 100), (11, "u", "y" * 100), (10, "u", "y" * 100), (None, "u", BIG), (12, "u", "\r\n\r\nWARC/1.1\r\n" * 30)]


@pytest.mark.parametrize("roll", [1, 1 << 20])
def test_round_trip(spark, tmp_path, roll):
    manifest = write(spark, ROWS, tmp_path / "w", roll_bytes=roll).collect()
    got = warc.read_archive(spark, str(tmp_path / "w")).collect()
    assert len(got) == len(ROWS) == sum(r["n_records"] for r in manifest)
    assert len(manifest) == len(ROWS) if roll == 1 else len(manifest) < len(ROWS)
    payloads = {r["payload_digest"]: bytes(r["payload"]) for r in got if r["record_type"] == "response"}
    as_written = sorted((str(p), hashlib.sha256((h or "").encode()).hexdigest(), len((h or "").encode())) for p, _, h in ROWS)
    assert sorted((str(r["page_id"]), r["payload_digest"], r["payload_bytes"]) for r in got) == as_written
    assert all(hashlib.sha256(b).hexdigest() == d for d, b in payloads.items())
    assert {(r["page_id"], r["refers_to"]) for r in got if r["record_type"] == "revisit"} == {(5, 3), (9, 3), (11, 10), (10, 10)}
    assert all((r["refers_to"] is None) == (r["record_type"] == "response") for r in got)
    for r in manifest:
        data = open(tmp_path / "w" / r["file"], "rb").read()
        assert hashlib.sha256(data).hexdigest() == r["sha256"] and len(data) == r["n_bytes"]
        assert gzip.decompress(data).startswith(b"WARC/1.1\r\nWARC-Type: warcinfo")
    firsts = [(r["file"], r["first_page"] if r["first_page"] is not None else -1, r["last_page"] if r["last_page"] is not None else -1) for r in sorted(manifest)]
    assert all(a[2] <= b[1] for a, b in zip(firsts, firsts[1:]))
    assert not glob.glob(str(tmp_path / "w" / "_temporary*"))


def test_same_bytes_again(spark, tmp_path):
    a, b = (sorted(map(tuple, write(spark, ROWS, tmp_path / x).select("file", "sha256").collect())) for x in "ab")
    assert a == b


def test_files_follow_from_the_rows(spark, tmp_path):
    """Other partitions and settings give the same files; small shards hold ascending ranges of pages, all rows once."""
    rows = [(i * 10**14 if i % 7 else None, f"u{i}", f"payload {i} " * 12) for i in range(-30, 60)]
    out, setting = [], spark.conf.get("spark.sql.shuffle.partitions")
    for n, parts in enumerate((1, 7)):
        spark.conf.set("spark.sql.shuffle.partitions", str(3 + n))
        df = spark.createDataFrame([(*r, 9, "f") for r in rows], SCHEMA).repartition(parts)
        out.append(sorted(map(tuple, warc.write_archive(df, str(tmp_path / str(n)), shard_bytes=1500).collect())))
    spark.conf.set("spark.sql.shuffle.partitions", setting)
    strip = lambda files: [(f[0], *f[2:]) for f in files]
    assert strip(out[0]) == strip(out[1]) and len(out[0]) > 5 and sum(f[2] for f in out[0]) == len(rows)
    spans = [f[5:] for f in out[0] if f[5] is not None]
    assert spans == sorted(spans) and all(a <= b for a, b in spans)
    assert warc.read_archive(spark, str(tmp_path / "1")).count() == len(rows)


def test_revisits_refer_to_the_record_of_their_payload(spark, tmp_path):
    """A page id with several payloads: each revisit names the record that holds its own."""
    rows = [(1, "u", "A" * 200), (1, "u", "B" * 200), (2, "u", "B" * 200), (3, "u", "A" * 200), (3, "u", "A" * 200)]
    write(spark, rows, tmp_path / "w")
    found = {}
    for file in glob.glob(str(tmp_path / "w" / "pages-*")):
        with open(file, "rb") as stream:
            for headers, _ in map(warc.parsed, warc.members(stream)):
                assert headers["WARC-Record-ID"] not in found
                found[headers["WARC-Record-ID"]] = headers
    revisits = [h for h in found.values() if h["WARC-Type"] == "revisit"]
    assert len(revisits) == 3
    for h in revisits:
        assert found[h["WARC-Refers-To"]]["WARC-Payload-Digest"] == h["WARC-Payload-Digest"] and found[h["WARC-Refers-To"]]["WARC-Type"] == "response"


def test_files_outside_the_manifest_are_not_read(spark, tmp_path):
    write(spark, ROWS[:4], tmp_path / "w")
    (tmp_path / "w" / "pages-99999-00000.warc.gz").write_bytes(b"left behind")
    assert warc.read_archive(spark, str(tmp_path / "w")).count() == 4


def test_commit_can_be_repeated(tmp_path):
    import pyarrow as pa
    (tmp_path / "_temporary").mkdir()
    (tmp_path / "_temporary" / "x.1").write_bytes(b"1")
    batch = pa.RecordBatch.from_arrays([pa.array(["x"]), pa.array(["_temporary/x.1"])], ["file", "temporary"])
    for _ in range(2):
        list(warc._commit([batch], str(tmp_path)))
    assert (tmp_path / "x").read_bytes() == b"1"


def test_damage_is_noticed(spark, tmp_path):
    file = write(spark, ROWS[:2], tmp_path / "w").first()["file"]
    data = gzip.decompress((tmp_path / "w" / file).read_bytes()).replace("é<p>".encode(), "è<p>".encode())
    with pytest.raises(ValueError):
        warc.parsed(data[data.index(b"WARC/1.1", 9):])
    (tmp_path / "w" / file).write_bytes((tmp_path / "w" / file).read_bytes()[:-20])
    with pytest.raises(Exception, match="ends within a record"):
        warc.read_archive(spark, str(tmp_path / "w")).collect()


def test_empty(spark, tmp_path):
    assert write(spark, ROWS[:1], tmp_path / "w").limit(0).count() == 0
    none = spark.createDataFrame([], SCHEMA)
    warc.write_archive(none, str(tmp_path / "none"))
    assert warc.read_archive(spark, str(tmp_path / "none")).count() == 0
