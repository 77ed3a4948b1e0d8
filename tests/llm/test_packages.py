"""WARC packages of other makers: several archives and indexes, bytes that no index covers, file systems by URI."""

import json

import pytest
from helpers import CLASHING

from linfold.llm import warczip
from linfold.llm.texts import on_workers
from linfold.session import fresh_name, shared_dir

DATE = "2024-01-01T00:00:00Z"


def archive(ids, name=None):
    """Bytes of an archive of these pages and the lines of its index, the last record first."""
    data, lines = b"", []
    for i in ids:
        payload = f"<p>{i}</p>".encode()
        made = warczip.record(i, f"http://x/{i}", payload, warczip.sha1_base32(payload), None, DATE)
        entry = {"offset": str(len(data)), "length": str(len(made))} | ({"filename": name} if name else {})
        lines.insert(0, f"x,http)/{i} 20240101000000 {json.dumps(entry)}\n".encode())
        data += made
    return data, lines


def package(spark, members, zip64=True):
    folder = shared_dir(spark, "warc", fresh_name("other"))
    files, base = warczip._files(warczip._qualified(spark, folder))
    files.create_dir(base, recursive=True)
    with files.open_output_stream(f"{base}/other.zip") as out:
        out.write(warczip.zip_bytes(members, zip64))
    return f"{folder}/other.zip"


def read(spark, *paths):
    on_workers(spark)
    rows = warczip.read(spark, spark.createDataFrame([(p,) for p in paths], "path string"), split_bytes=300).collect()
    return sorted((r["record_id"], bytes(r["payload"])) for r in rows)


def want(ids):
    return sorted((f"<urn:page:{i}>", f"<p>{i}</p>".encode()) for i in ids)


@pytest.mark.parametrize("zip64", [True, False])
def test_all_archives_and_indexes_are_read(spark, zip64):
    a, la = archive(range(9), "a.warc.gz")
    b, lb = archive(range(20, 23), "more/b.warc.gz")
    path = package(spark, [
        ("datapackage.json", b"{}"), ("archive/a.warc.gz", a), ("archive/more/b.warc.gz", b), ("archive/none.warc.gz", b""),
        ("indexes/one.cdxj", b"!meta\n" + b"".join(la[:5] + lb)), ("indexes/two.cdxj", b"".join(la[3:])),  # some twice
        ("pages/pages.jsonl", b"?")], zip64)
    single, lines = archive([50, 51])
    other = package(spark, [("archive/data.warc.gz", single), ("indexes/index.cdxj", b"".join(lines))], zip64)
    assert read(spark, path, other) == want([*range(9), 20, 21, 22, 50, 51])


def test_what_no_index_covers_is_an_error(spark):
    a, lines = archive(range(4), "a.warc.gz")
    for some, text in ((lines[1:], "cover"), (lines[:-1], "cover"), (lines[:1] + lines[2:], "cover"), ([], "cover"),
                       (lines + [lines[0].replace(b"a.warc", b"z.warc")], "no known archive")):
        path = package(spark, [("archive/a.warc.gz", a), ("indexes/i.cdxj", b"".join(some))])
        with pytest.raises(Exception, match=text):
            read(spark, path)
    _, unnamed = archive(range(4))
    path = package(spark, [("archive/a.warc.gz", a), ("archive/b.warc.gz", a), ("indexes/i.cdxj", b"".join(unnamed))])
    with pytest.raises(Exception, match="no known archive"):
        read(spark, path)
    with pytest.raises(Exception, match="not a stored member"):
        read(spark, package(spark, [("archive/a.warc", a)]))


def test_file_systems_by_uri(spark):
    for path in ("dbfs:/x/y", "what:/x", "hdfs:/x"):
        with pytest.raises(ValueError, match="no file system"):
            warczip._files(path)
    with pytest.raises(Exception, match="(?i)scheme|filesystem"):
        warczip._files("nosuch://bucket/x")
    for path in ("/a/b", "file:/a/b", "file:///a/b"):
        assert warczip._files(path)[1] == "/a/b"
    assert warczip._qualified(spark, "/a/b") == "file:/a/b"


def test_pages_with_clashing_columns_and_long_payloads(spark):
    on_workers(spark)
    names = [c for c in CLASHING if c != "key"] + ["digest", "first", "refers_to", "path", "record_id"]
    rows = [(1, "u", "ab" * 3_000_000, *["x"] * len(names)), (2, "u", "ab" * 3_000_000, *["x"] * len(names)), (3, None, "", *["x"] * len(names))]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string, " + ", ".join(f"{c} string" for c in names))
    packages = warczip.write(pages, shared_dir(spark, "warc", fresh_name("t")), package_bytes=1000)
    got = warczip.read(spark, packages, split_bytes=1000).collect()
    assert sorted((r["record_id"], r["record_type"], r["payload_bytes"], r["refers_to"]) for r in got) == [
        ("<urn:page:1>", "response", 6_000_000, None), ("<urn:page:2>", "revisit", 6_000_000, "<urn:page:1>"),
        ("<urn:page:3>", "response", 0, None)]
