"""Archives that lie on disk, damaged there, audited by the bytes found."""

import os
import shutil
from pathlib import Path

import pytest

from millrace.llm import warc


@pytest.fixture
def archive(spark, folder):
    """The pages as records in some files, their manifest and the folder."""
    pages = spark.read.parquet("/root/testdata/sf0.001/pages.parquet")
    made = warc.records(pages, 8)
    known = warc.manifest(warc.hashed(made)).cache()
    warc.write_archive(made, f"{folder}/original")
    return known, f"{folder}/original"


def files_of(path):
    found = {}
    for name in Path(path).glob("file=*/part-*"):
        assert name.parent.name not in found
        found[name.parent.name] = name
    return {int(name.split("=")[1]): file for name, file in found.items()}


def status(known, path):
    return {(r["file"], r["offset"]): r["status"] for r in warc.audit_stored(known, path).collect()}


def rows_of(known):
    out = {}
    for r in known.orderBy("file", "offset").collect():
        out.setdefault(r["file"], []).append((r["offset"], r["length"]))
    return out


def rewrite(file, data):
    os.chmod(file, 0o644)
    file.write_bytes(data)
    checksum = file.parent / f".{file.name}.crc"
    if checksum.exists():
        checksum.write_bytes(b"")
        checksum.unlink()


def test_a_stored_archive_is_what_was_written(archive):
    known, path = archive
    assert len(files_of(path)) > 2 and status(known, path) == {}


def test_damage_to_stored_bytes_is_found(archive, folder):
    known, path = archive
    shutil.copytree(path, f"{folder}/replica")
    places, files = rows_of(known), files_of(f"{folder}/replica")
    names = sorted(name for name in files if len(places[name]) > 3)
    changed, cut, dropped, inserted = names[:4] if len(names) > 3 else (names * 4)[:4]
    assert len({changed, cut, dropped, inserted}) == 4
    want = {}

    data = bytearray(files[changed].read_bytes())
    offset, length = places[changed][2]
    data[offset + length // 2] ^= 1
    rewrite(files[changed], bytes(data))
    want[changed, offset] = "changed"

    data = files[cut].read_bytes()
    offset, length = places[cut][-2]
    rewrite(files[cut], data[:offset + 5])
    want |= {(cut, offset): "changed", (cut, places[cut][-1][0]): "missing"}

    data = files[dropped].read_bytes()
    offset, length = places[dropped][1]
    rewrite(files[dropped], data[:offset] + data[offset + length:])
    end = len(data) - length
    want |= {(dropped, o): "missing" if o >= end else "changed" for o, _ in places[dropped][1:]}

    data = files[inserted].read_bytes()
    rewrite(files[inserted], data + b"WARC/1.1\r\n")
    want[inserted, len(data)] = "extra"
    assert status(known, f"{folder}/replica") == want and status(known, path) == {}


def test_a_file_that_is_gone(archive, folder):
    known, path = archive
    gone = sorted(files_of(path))[0]
    shutil.copytree(path, f"{folder}/replica", ignore=lambda _, names: [n for n in names if n == f"file={gone}"])
    want = {(gone, offset): "missing" for offset, _ in rows_of(known)[gone]}
    assert status(known, f"{folder}/replica") == want


def test_an_empty_archive(spark, folder):
    pages = spark.read.parquet("/root/testdata/sf0.001/pages.parquet").limit(0)
    made = warc.records(pages)
    known = warc.manifest(warc.hashed(made))
    os.makedirs(f"{folder}/nothing")
    assert warc.audit_stored(known, f"{folder}/nothing").count() == 0
