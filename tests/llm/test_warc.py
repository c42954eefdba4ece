"""Packages written and read back."""

import hashlib
import io
import zipfile

import pytest

from rolodeck.llm import warc as W


class File(io.BytesIO):
    def size(self):
        return len(self.getvalue())


def zipped(names, comment=b"", method=zipfile.ZIP_STORED, force=False):
    out = io.BytesIO()
    with zipfile.ZipFile(out, "w", method) as z:
        for n in names:
            with z.open(n, "w", force_zip64=force) as f:
                f.write(n.encode() * 3)
        z.comment = comment
    return File(out.getvalue())


@pytest.mark.parametrize("force", [False, True])
@pytest.mark.parametrize("comment", [b"", b"PK some words" * 100])
def test_directory(force, comment):
    f = zipped(["a/b.txt", "é", "c"], comment, force=force)
    members = W.central_directory(f)
    assert list(members) == ["a/b.txt", "é", "c"]
    for name, entry in members.items():
        at, n = W.stored_range(f, entry)
        assert f.getvalue()[at : at + n] == name.encode() * 3


def test_zip64_directory():
    """More members than 16 bits count need the ZIP64 end record."""
    names = [f"{i}" for i in range(66_000)]
    members = W.central_directory(zipped(names))
    assert len(members) == 66_000 and list(members)[-1] == "65999"


def test_zip64_offsets():
    """A member's sizes and offset in the ZIP64 extra field of the central directory."""
    import struct

    local = struct.pack("<4s5H3I2H", b"PK\3\4", 45, 0, 0, 0, 0, 0, 3, 3, 1, 0) + b"n" + b"abc"
    extra = struct.pack("<2H3Q", 1, 24, 3, 3, 0)
    central = struct.pack("<4s6H3I5H2I", b"PK\1\2", 45, 45, 0, 0, 0, 0, 0, 0xFFFFFFFF, 0xFFFFFFFF, 1, len(extra), 0, 0, 0, 0, 0xFFFFFFFF) + b"n" + extra
    end = struct.pack("<4sH4I", b"PK\5\6", 0, 0, 0, 0, 0)
    at = len(local)
    zip64 = struct.pack("<4sQ2H2I4Q", b"PK\6\6", 44, 45, 45, 0, 0, 1, 1, len(central), at) + struct.pack("<4sIQI", b"PK\6\7", 0, at + len(central), 1)
    end = struct.pack("<4s4H2IH", b"PK\5\6", 0, 0, 0xFFFF, 0xFFFF, 0xFFFFFFFF, 0xFFFFFFFF, 0)
    f = File(local + central + zip64 + end)
    assert W.central_directory(f) == {"n": (0, 3, 0)}
    assert W.stored_range(f, (0, 3, 0)) == (31, 3)


def test_compressed_members_and_other_files_are_refused():
    f = zipped(["x" * 50], method=zipfile.ZIP_DEFLATED)
    with pytest.raises(ValueError, match="compressed"):
        W.stored_range(f, next(iter(W.central_directory(f).values())))
    with pytest.raises(ValueError, match="not a ZIP"):
        W.central_directory(File(b"hello" * 10))


def test_broken_digest():
    raw = W.record(1, "u", b"x", "0" * 64, 1, None, False, "d")
    with pytest.raises(ValueError, match="digest"):
        W.parse_record(raw)


def test_round_trip(spark):
    long = "é" * 60
    rows = [(5, "http://a/ b\r\n", long), (2, "u", long), (9, None, long), (1, "u", "short"), (3, "u", "short"), (4, "u", None), (6, "u", ""), (None, "u", long), (7, "u", "q" * 200_000), (2, "u", long)]
    df = spark.createDataFrame(rows, "page_id long, url string, html string").selectExpr("*", "1 as digest", "2 as path")
    manifest = W.write_packages(df, package_mb=0)  # one record fills a package
    assert manifest.count() == len(rows)
    got = W.read_packages(manifest).collect()
    assert len(got) == len(rows)
    for r in got:
        want = next((h or "").encode() for p, _, h in rows if p == r.page_id)
        assert (r.payload_bytes, r.payload_digest) == (len(want), hashlib.sha256(want).hexdigest())
        revisit = want == long.encode() and r.page_id != 2
        assert (r.record_type, r.refers_to) == (("revisit", 2) if revisit else ("response", None))
        assert r.payload == (b"" if revisit else want)
    one = W.write_packages(df.coalesce(1))
    assert one.count() == 1 and sorted(map(str, W.read_packages(one, range_mb=1).collect())) == sorted(map(str, got))


def test_broadcast_and_join_agree(spark, monkeypatch):
    df = spark.range(60).selectExpr("id as page_id", "'u' as url", "repeat(cast(id % 7 as string), 120) as html")
    rows = lambda: sorted(W.read_packages(W.write_packages(df), payloads=False).collect(), key=lambda r: r.page_id)
    one = rows()
    monkeypatch.setattr(W, "BROADCAST_ROWS", 0)
    assert rows() == one and one[10].refers_to == 3


def test_empty(spark):
    manifest = W.write_packages(spark.createDataFrame([], "page_id long, url string, html string"))
    assert manifest.count() == 0 and W.read_packages(manifest).count() == 0


def test_packages_are_read_by_many_tasks(spark):
    """Eight packages give eight tasks at least, though the table of ranges is tiny."""
    df = spark.range(64).selectExpr("id as page_id", "'u' as url", "repeat(cast(id as string), 50) as html").repartition(8)
    manifest = W.write_packages(df)
    found = W.read_packages(manifest, payloads=False)
    assert manifest.count() == 8 and found.rdd.getNumPartitions() >= 8 and found.count() == 64


def test_a_payload_of_many_pages_by_the_join(spark, monkeypatch):
    monkeypatch.setattr(W, "BROADCAST_ROWS", 0)
    df = spark.range(3000).selectExpr("id as page_id", "'u' as url", "repeat(if(id % 3 = 0, 'hot', cast(id % 1000 as string)), 100) as html")
    got = {r.page_id: r.refers_to for r in W.read_packages(W.write_packages(df), payloads=False).collect()}
    first = {}
    for i in range(3000):
        first.setdefault("hot" if i % 3 == 0 else i % 1000, i)
    assert got == {i: f if (f := first["hot" if i % 3 == 0 else i % 1000]) != i else None for i in range(3000)}
