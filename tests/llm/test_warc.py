import gzip
import hashlib
import re

import pytest

from pageloom.llm.warc import page_records, read_warc, record_text, salvage, with_revisits, write_warc

SCHEMA = "page_id long, url string, html string, payload string, id string"


def pages(spark, rows):
    return spark.createDataFrame([(i, u, h, "x", "y") for i, u, h in rows], SCHEMA)


def records(spark, rows):
    got = record_text(with_revisits(pages(spark, rows))).collect()
    return [r.record.encode() + b"\r\n\r\n" for r in got]


BIG = "é" * 60
ROWS = [(5, "u5", BIG), (3, "u\r\n3", BIG), (9, None, BIG), (1, "a", "tiny"), (2, "b", "tiny"), (4, "c", None), (6, "d", ""),
        (7, "e", "WARC/1.1\r\nfake\r\n\r\n" + "z" * 200), (8, "f", "line\nends\r\n\r\n" * 4000), (10, "g", "x" * 99), (11, "h", "x" * 99),
        (12, "i", "y" * 100), (13, "j", "y" * 100), (None, "k", BIG), (12, "i", "y" * 100)]


def want(rows):
    out = []
    for i, _, h in rows:
        data = (h or "").encode()
        ids = [j for j, _, g in rows if (g or "") == (h or "") and j is not None]
        first = min(ids) if ids and len(data) >= 100 else None
        refers = first if first is not None and first != i else None
        out.append((i, len(data), hashlib.sha256(data).hexdigest(), "revisit" if refers is not None else "response", refers))
    return sorted(out, key=repr)


def test_round_trip(spark, tmp_path):
    path = str(tmp_path / "archives")
    write_warc(with_revisits(pages(spark, ROWS)), path, records_per_file=4)
    got = read_warc(spark, path)
    assert got.where("kind = 'gap'").count() == 0
    assert sorted(map(tuple, page_records(got).collect()), key=repr) == want(ROWS)
    payloads = {r.record_id: bytes(r.payload).decode() for r in got.where("kind = 'response'").collect()}
    assert payloads["<urn:page:8>"] == ROWS[8][2] and payloads["<urn:page:4>"] == ""


def test_empty_table(spark, tmp_path):
    path = str(tmp_path / "none")
    write_warc(with_revisits(pages(spark, [])), path)
    assert read_warc(spark, path).count() == 0


@pytest.fixture(scope="module")
def parts(spark):
    return records(spark, [(k, f"u{k}", f"page {k} " * 20) for k in range(6)])


def test_salvage_of_damaged_plain_archives(parts):
    whole = b"".join(parts)
    assert len(salvage(whole).records) == 6 and not salvage(whole).gaps
    broken = parts[0] + parts[1].replace(b"page 1", b"PAGE 1", 1) + parts[2] + b"noise" + parts[3][: len(parts[3]) // 2] + parts[4] + parts[5][:-30]
    got = salvage(broken)
    assert [r["url"] for r in got.records] == ["u0", "u2", "u4"]
    a, b = len(parts[0]), len(parts[0] + parts[1])
    assert got.gaps[0] == (a, b, "payload digest differs")
    assert sum(y - x for x, y, _ in got.gaps) == len(broken) - sum(len(parts[k]) for k in (0, 2, 4))
    assert salvage(b"").records == [] and salvage(b"noise only").gaps == [(0, 10, "no version line")]


def test_salvage_of_damaged_gzip_archives(parts):
    zipped = [gzip.compress(p) for p in parts]
    assert len(salvage(b"".join(zipped)).records) == 6
    spoiled = bytearray(zipped[1])
    spoiled[len(spoiled) // 2] ^= 0xFF
    broken = zipped[0] + bytes(spoiled) + zipped[2] + b"\x00\x00junk" + zipped[3] + gzip.compress(b"no record") + zipped[4] + zipped[5][:-60]
    got = salvage(broken)
    assert [r["url"] for r in got.records] == ["u0", "u2", "u3", "u4"]
    lost = len(broken) - sum(len(zipped[k]) for k in (0, 2, 3, 4))
    assert sum(y - x for x, y, _ in got.gaps) == lost


def test_records_before_a_fault_are_kept(parts):
    zipped = gzip.compress(b"".join(parts[:3]))
    got = salvage(zipped[:-12] + gzip.compress(parts[4]))
    assert [r["url"] for r in got.records][:2] == ["u0", "u1"] and got.records[-1]["url"] == "u4"
    (start, end, why), = got.gaps
    assert 0 < start < end == len(zipped) - 12 and "gzip" in why  # the bytes that gave records are in no gap


def test_gaps_become_rows(spark, parts, tmp_path):
    (tmp_path / "a.warc").write_bytes(parts[0] + b"???" + parts[1])
    rows = read_warc(spark, str(tmp_path)).orderBy("offset").collect()
    assert [r.kind for r in rows] == ["response", "gap", "response"]
    assert (rows[1].offset, rows[1].gap_end) == (len(parts[0]), len(parts[0]) + 3)


def test_damage_costs_one_record(spark, tmp_path):
    path = tmp_path / "damaged"
    rows = [(k, f"u{k}", f"page {k} " + hashlib.sha256(str(k).encode()).hexdigest() * 9) for k in range(300)]
    write_warc(with_revisits(pages(spark, rows).coalesce(1)), str(path))
    (archive,) = [f for f in path.glob("part-*") if f.stat().st_size]
    data = bytearray(archive.read_bytes())
    assert len(gzip.decompress(data)) > 300 * 600  # members in a row, as any gzip reader takes them
    at = len(data) // 10
    data[at : at + 4] = bytes(b ^ 0xFF for b in data[at : at + 4])
    got = salvage(bytes(data))
    assert len(got.records) >= 298 and not any(r["in_gap"] for r in got.records)
    assert len(got.gaps) == 1 and got.gaps[0][0] <= at + 4 and got.gaps[0][1] > at
    assert not any(got.gaps[0][0] <= r["offset"] < got.gaps[0][1] for r in got.records)


def test_archives_are_bounded_by_bytes(spark, tmp_path):
    path = tmp_path / "bounded"
    noise = [hashlib.shake_256(str(k).encode()).hexdigest(2000) for k in range(40)]
    write_warc(with_revisits(pages(spark, [(k, "u", t) for k, t in enumerate(noise)])), str(path), archive_bytes=20_000)
    sizes = [f.stat().st_size for f in path.glob("part-*")]
    assert len([n for n in sizes if n]) > 4 and max(sizes) <= 20_000
    assert page_records(read_warc(spark, str(path))).count() == 40


def test_a_payload_of_many_megabytes(spark, tmp_path):
    path = str(tmp_path / "long")
    long = "long words " * 1_800_000
    write_warc(with_revisits(pages(spark, [(1, "u", long), (2, "v", "short"), (3, "w", long)]).coalesce(1)), path)
    got = read_warc(spark, path)
    assert got.where("kind = 'gap'").count() == 0
    assert [(r.page_id, r.payload_bytes, r.record_type, r.refers_to) for r in page_records(got).orderBy("page_id").collect()] == [
        (1, len(long), "response", None), (2, 5, "response", None), (3, len(long), "revisit", 1)]


def test_records_inside_a_payload_are_no_pages(spark, parts, tmp_path):
    inner = records(spark, [(7777, "inner", "inside " * 30)])[0]
    html = "before " + inner.decode() + "after"
    outer = records(spark, [(5, "outer", html)])[0]
    size = int(re.search(rb"Content-Length: (\d+)\r\n\r\nHTTP", outer)[1])
    longer = outer.replace(b"Content-Length: %d\r\n\r\nHTTP" % size, b"Content-Length: %d\r\n\r\nHTTP" % (size + 3))
    assert longer != outer
    got = salvage(parts[0] + longer + parts[1])
    assert [r["url"] for r in got.records] == ["u0", "u1"]  # the digest tells where the outer record ends
    assert [(a, b) for a, b, _ in got.gaps] == [(len(parts[0]), len(parts[0]) + len(longer))]

    beheaded = b"XXXX" + outer[4:]
    (tmp_path / "a.warc").write_bytes(parts[0] + beheaded + parts[1] + parts[2])
    rows = read_warc(spark, str(tmp_path))
    assert {r.url: r.in_gap for r in rows.where("kind <> 'gap'").collect()} == {"u0": False, "inner": True, "u1": False, "u2": False}
    assert 7777 not in [r.page_id for r in page_records(rows).collect()]


def test_gaps_in_a_member_of_many_records(parts):
    zipped = gzip.compress(b"".join(parts[:2]) + b"noise in between" + parts[2])
    got = salvage(zipped + gzip.compress(parts[3]))
    assert [r["url"] for r in got.records] == ["u0", "u1", "u2", "u3"]
    assert len(got.gaps) == 1 and 0 < got.gaps[0][0] < got.gaps[0][1] <= len(zipped)
