import hashlib
import io
import zipfile

import pytest

from wattline.llm import warc_zip

SCHEMA = "page_id long, url string, html string, digest string, first string, payload string"


def pages(spark, rows):
    return spark.createDataFrame([(*r, "own", "own", "own") for r in rows], SCHEMA)


def expected(rows):
    first = {}
    for i, _, html in rows:
        if i is not None:
            first[html or ""] = min(first.get(html or "", i), i)
    out = []
    for i, url, html in rows:
        data, least = (html or "").encode(), first.get(html or "")
        refers = least if len(data) >= 100 and least is not None and i != least else None
        digest = hashlib.sha256(data).hexdigest()
        out.append((i, url or "", "response" if refers is None else "revisit", refers, len(data), digest, data if refers is None else None))
    return out


def back(spark, rows, **options):
    path = warc_zip.save(pages(spark, rows), **options)
    found = [(*r[:6], None if r.payload is None else bytes(r.payload)) for r in warc_zip.read(spark, path).collect()]
    return path, found


def order(rows):
    return sorted(rows, key=str)


def test_round_trip_with_revisits_and_awkward_pages(spark):
    same = "<p>é ☃ same</p>" * 20
    rows = [(3, "http://a/", same), (7, "u\r\nx: y", same), (5, None, same), (1, "u", None), (2, "u", ""), (4, "", "short"), (6, "", "short")]
    rows += [(None, "u", same), (None, "u", "x" * 200), (None, "u", "x" * 200), (9, "u", "y" * 300), (9, "u", "y" * 300)]
    rows += [(20, "long", "\r\n\r\nWARC/1.1 " * 200_000)]
    wanted = [(i, (u or "").replace("\r", "").replace("\n", ""), *rest) for i, u, *rest in expected(rows)]
    assert order(back(spark, rows)[1]) == order(wanted)
    assert order(back(spark, rows, package_bytes=300)[1]) == order(wanted)


def test_no_pages(spark):
    assert back(spark, [])[1] == []


def test_packages_are_zip_files_of_warc_records(spark):
    path, found = back(spark, [(i, "http://a/", f"page {i} " * 50) for i in range(40)], package_bytes=2000)
    files = spark.read.format("binaryFile").load(path).collect()
    assert len(files) > 1
    records = 0
    for f in files:
        with zipfile.ZipFile(io.BytesIO(bytes(f.content))) as z:
            assert z.testzip() is None and {i.compress_type for i in z.infolist()} == {zipfile.ZIP_STORED}
            records += len(z.read(warc_zip.INDEX).splitlines())
    assert records == len(found) == 40


class Bytes(warc_zip.Ranges):
    def __init__(self, data):
        self.file, self.size, self.asked = io.BytesIO(data), len(data), 0

    def __call__(self, place, length):
        self.file.seek(place)
        self.asked += length
        return self.file.read(length)


@pytest.mark.parametrize("limit", [None, 50])
@pytest.mark.parametrize("comment", [b"", b"\n", b"a PK\x05\x06 in the comment that is longer than an end record"])
def test_directories_with_and_without_zip64(monkeypatch, limit, comment):
    if limit:
        monkeypatch.setattr(zipfile, "ZIP64_LIMIT", limit)
        monkeypatch.setattr(zipfile, "ZIP_FILECOUNT_LIMIT", 2)
    out, parts = io.BytesIO(), {f"member {k}": bytes([k]) * (k * 40) for k in range(6)}
    with zipfile.ZipFile(out, "w", zipfile.ZIP_STORED) as z:
        for name, data in parts.items():
            with z.open(zipfile.ZipInfo(name), "w", force_zip64=bool(limit)) as f:
                f.write(data)
        z.writestr(zipfile.ZipInfo("deflated"), "d" * 500, zipfile.ZIP_DEFLATED)
        z.comment = comment
    assert (b"PK\x06\x06" in out.getvalue()) == bool(limit)
    read = Bytes(out.getvalue())
    members = {m.name: m for m in warc_zip.directory(read)}
    assert {n for n, m in members.items() if m.method == warc_zip.STORED} == set(parts)
    assert all(read(members[n].place, members[n].size) == data for n, data in parts.items())


def test_other_files_are_refused():
    with pytest.raises(ValueError, match="not a ZIP file"):
        warc_zip.directory(Bytes(b"nothing of the kind" * 10))


def test_only_ranges_are_read():
    big = zipfile.ZipFile(out := io.BytesIO(), "w")
    big.writestr("data", b"x" * 2_000_000)
    big.close()
    read = Bytes(out.getvalue())
    warc_zip.directory(read)
    assert read.asked < 100_000
