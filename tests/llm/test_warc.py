"""WARC: SQL parity, byte-exact round trips, salvage after every kind of damage."""

import gzip
import random

import pytest
from pyspark.sql import functions as F

from oracle_compare import compare, duck
from tidemark.llm import warc

SF = "/root/testdata/sf0.01"


def test_matches_sql(spark):
    result = compare(warc.op1_warc(spark, SF), warc.OP1_SQL, duck(SF))
    assert result["match"], result


def sample(n=12, compressed=True):
    rnd = random.Random(n)
    records = []
    for i in range(n):
        payload = bytes(rnd.randrange(256) for _ in range(rnd.choice([0, 5, 900])))
        digest = warc.hashlib.sha256(payload).hexdigest()
        records.append(warc.record_bytes(i, f"http://x/{i}", payload, digest, i - 1 if i % 5 == 4 else None))
    return [warc.member_bytes(r) if compressed else r for r in records]


def ids(found):
    return [int(x.headers["warc-record-id"][len(warc.ID_PREFIX) + 1:-1]) for x in found if isinstance(x, warc.Record)]


@pytest.mark.parametrize("compressed", [True, False])
def test_whole_file(compressed):
    parts = sample(compressed=compressed)
    found = list(warc.salvage(b"".join(parts)))
    assert ids(found) == list(range(12)) and not any(isinstance(x, warc.Gap) for x in found)
    assert [x.length for x in found] == [len(p) for p in parts]


@pytest.mark.parametrize("compressed", [True, False])
@pytest.mark.parametrize("damage", ["flip", "cut", "insert", "magic", "tail"])
def test_salvage(compressed, damage):
    for seed in range(25):
        rnd = random.Random(seed)
        parts = sample(compressed=compressed)
        hit = rnd.randrange(1, 11)
        bad = bytearray(parts[hit])
        # header lines of uncompressed records have no check sum: damage the block
        first = 20 if compressed else bad.index(b"\r\n\r\n") + 4
        if damage == "flip":
            at = rnd.randrange(first, len(bad) - 4)
            bad[at] ^= 0x55
        elif damage == "cut":
            at = rnd.randrange(first, len(bad) - 1)
            del bad[at:at + rnd.randrange(1, 40)]
        elif damage == "insert":
            bad[30:30] = bytes(rnd.randrange(256) for _ in range(50)) + warc.MAGIC + b"WARC/1.1\r\n"
        elif damage == "magic":
            bad[0] = 0
        else:
            parts = parts[:hit + 1]
            bad = bad[:len(bad) // 2]
        parts[hit] = bytes(bad)
        data = b"".join(parts)
        found = list(warc.salvage(data))
        assert [i for i in ids(found) if i != hit] == [i for i in range(len(parts)) if i != hit], (seed, hit)
        if hit in ids(found):   # only the member's own check was hit: the record is whole
            assert compressed and damage in ("flip", "cut")
            block = next(x.block for x in found if isinstance(x, warc.Record) and ids([x]) == [hit])
            assert block == next(x.block for x in warc.salvage(sample(compressed=True)[hit])
                                 if isinstance(x, warc.Record))
        begin = sum(map(len, parts[:hit]))
        gaps = [x for x in found if isinstance(x, warc.Gap)]
        assert [(g.offset, g.length) for g in gaps] == [(begin, len(parts[hit]))]
        assert gaps[0].reason


def test_foreign_and_multi_record_members():
    a, b, c = sample(3, compressed=False)
    data = gzip.compress(a + b) + b"junk between" + gzip.compress(c)
    found = list(warc.salvage(data))
    assert ids(found) == [0, 1, 2]
    assert [(g.offset, g.length) for g in found if isinstance(g, warc.Gap)] == [(len(gzip.compress(a + b)), 12)]
    assert list(warc.salvage(b"")) == []
    assert [g.length for g in warc.salvage(b"no archive at all")] == [17]


def test_long_records_end_with_a_zero_byte():
    record = warc.record_bytes(1, None, b"x" * (17 << 20), "0" * 64, 3)
    big = b"WARC/1.1\r\n" + b"y" * (17 << 20)
    for raw in (record, big):
        assert warc.member_bytes(raw).endswith(b"\0")


def test_edge_rows_and_damaged_files(spark, tmp_path):
    long = "long enough to be shared " * 20
    rows = [(5, "http://a/\r\nX: y", long), (2, None, long), (2, None, long), (None, "u", long), (7, "u", None),
            (8, "u", ""), (9, "u", "é" * 40), (10, "u", "é" * 40), (11, "u", "x" * 300_000)]
    pages = (spark.createDataFrame(rows, "page_id long, url string, html string").coalesce(1)
             .withColumn("digest", F.lit("clash")))
    path = str(tmp_path / "archives")
    warc.write_archives(pages, path)
    out = warc.read_archives(spark, path).collect()
    assert len(out) == len(rows) and all(r["gap"] is None for r in out)
    kinds = sorted((r["record_id"][len(warc.ID_PREFIX) + 1:-1][:4], r["warc_type"], r["refers_to"]) for r in out)
    to2 = f"<{warc.ID_PREFIX}2>"
    assert kinds == sorted([("5", "revisit", to2), ("2", "response", None), ("2", "response", None),
                            ("none", "revisit", to2), *[(str(i), "response", None) for i in (7, 8, 9, 10, 11)]])
    assert {r["payload_bytes"] for r in out if r["payload_digest"] == warc.hashlib.sha256(long.encode()).hexdigest()
            } == {len(long)}
    assert any(bytes(r["payload"] or b"") == ("é" * 40).encode() for r in out)

    # damage the files: everything else is still read, and the gap is logged
    for file in (tmp_path / "archives").glob("*/part-*"):
        data = bytearray(file.read_bytes())
        data[len(data) // 2] ^= 0xFF
        (file.parent / f".{file.name}.crc").unlink(missing_ok=True)
        file.write_bytes(bytes(data))
    again = warc.read_archives(spark, path, with_payload=False).collect()
    gaps = [r for r in again if r["gap"] is not None]
    assert gaps and len(again) - len(gaps) >= len(rows) - len(gaps) - 1
    empty = str(tmp_path / "empty")
    warc.write_archives(pages.limit(0), empty)
    assert warc.read_archives(spark, empty).count() == 0


def test_bad_record_inside_a_member():
    parts = sample(6, compressed=False)
    bad = bytearray(parts[2])
    bad[bad.index(b"\r\n\r\n") + 8] ^= 0x55
    data = gzip.compress(b"".join([*parts[:2], bytes(bad), *parts[3:]]))
    found = list(warc.salvage(data))
    begin = len(parts[0]) + len(parts[1])
    assert ids(found) == [0, 1, 3, 4, 5]
    gaps = [x for x in found if isinstance(x, warc.Gap)]
    assert [(g.offset, g.length) for g in gaps] == [(0, len(data))]
    assert gaps[0].reason.endswith(f"(inflated bytes {begin} to {begin + len(bad)})")


@pytest.mark.parametrize("digests", [True, False])
def test_damaged_members_give_back_what_comes_before(digests):
    parts = sample(20, compressed=False)
    if not digests:
        parts = [p.replace(b"WARC-Block-Digest", b"X-Block").replace(b"WARC-Payload-Digest", b"X-Payload") for p in parts]
    member, after = gzip.compress(b"".join(parts)), sample(3)
    whole = [len(b"".join(parts[:k])) for k in range(21)]
    rnd = random.Random(8)
    for place in [len(member) - 10, int(len(member) * 0.9), *[rnd.randrange(30, len(member)) for _ in range(25)]]:
        cut = list(warc.salvage(member[:place]))                       # nothing after it
        inflated = len(warc.zlib.decompressobj(31).decompress(member[:place]))
        assert ids(cut) == list(range(sum(w <= inflated for w in whole[1:])))
        assert [(g.offset, g.length) for g in cut if isinstance(g, warc.Gap)] == [(0, place)]
        bad = bytearray(member)
        bad[place] ^= 0x55
        found = list(warc.salvage(bytes(bad) + b"".join(after)))       # later members follow
        assert ids([x for x in found if x.offset >= len(bad)]) == [0, 1, 2]
        # behind the damage a header may be wrong and still parse: headers have no check sum
        early = [x.headers["warc-record-id"] for x in found if isinstance(x, warc.Record) and x.offset < len(bad)]
        if digests:
            intact = len(warc.zlib.decompressobj(31).decompress(member[:place]))
            n = sum(w <= intact for w in whole[1:])
            assert early[:n] == [f"<{warc.ID_PREFIX}{k}>" for k in range(n)]
        gaps = [g for g in found if isinstance(g, warc.Gap)]
        assert gaps and gaps[-1].offset == 0 and gaps[-1].length == len(bad)


def test_foreign_names_and_files_cut_by_bytes(spark, tmp_path, monkeypatch):
    (tmp_path / "crawl" / "deep").mkdir(parents=True)
    (tmp_path / "crawl" / "crawl-0001.warc.gz").write_bytes(b"".join(sample(4)))
    (tmp_path / "crawl" / "deep" / "other.warc").write_bytes(b"".join(sample(3, compressed=False)))
    assert warc.read_archives(spark, str(tmp_path / "crawl")).count() == 7
    assert warc.read_archives(spark, str(tmp_path / "crawl"), names="*.gz").count() == 4
    monkeypatch.setattr(warc, "FILE_BYTES", 20_000)
    rnd = random.Random(5)
    rows = [(i, "u", "".join(chr(rnd.randrange(33, 126)) for _ in range(3000))) for i in range(60)]
    path = str(tmp_path / "many")
    warc.write_archives(spark.createDataFrame(rows, "page_id long, url string, html string").coalesce(1), path)
    files = [f.stat().st_size for f in (tmp_path / "many").glob("*/part-*")]
    assert len(files) > 4 and max(files) < 30_000
    assert warc.read_archives(spark, path).where("gap is null").count() == 60
