"""Archives: round trip, revisits and salvage."""

import gzip
import random

import pytest

from broadsheet.llm import warc


def pages():
    source = random.Random(1)
    rows = [(i, f"https://a.org/{i}?q=é x", "".join(source.choice("abé\r\n<>") for _ in range(source.randrange(300)))) for i in range(60)]
    rows += [(100, "u", "same"), (101, "v", "same"), (99, None, "same"), (102, "w", None), (103, "w", ""), (104, "z", "WARC/1.1\r\n\r\n")]
    return [*rows, (105, "noise", "".join(chr(source.randrange(32, 40000)) for _ in range(200_000)))]


def test_round_trip(spark, tmp_path):
    rows = [(*r, "x") for r in pages()] + [(None, "n", "no id", "x"), (None, "n", "same", "x")]
    frame = spark.createDataFrame(rows, "page_id long, url string, html string, digest string")
    warc.write_archives(frame, f"{tmp_path}/out")
    back = warc.read_archives(spark, f"{tmp_path}/out").collect()
    assert not [r for r in back if r.problem]
    assert len(back) == len(rows)
    want = {}
    for page_id, _, text, _ in rows:
        if page_id is not None:
            payload = (text or "").encode()
            first = min(p for p, _, t, _ in rows if (t or "") == (text or "") and p is not None)
            want[f"urn:page:{page_id}"] = (payload, first if first != page_id else None)
    for r in back:
        if r.record_id == "urn:page:":
            continue
        payload, first = want[r.record_id]
        assert (r.payload_bytes, r.payload_digest) == (len(payload), warc.base32_sha1(payload))
        assert r.record_type == ("revisit" if first is not None else "response")
        assert r.refers_to == (None if first is None else f"urn:page:{first}")
        assert first is not None or bytes(r.payload) == payload
    # Any gzip reader can read the files.
    for file in (tmp_path / "out").glob("part-*"):
        assert gzip.decompress(file.read_bytes()).startswith(b"WARC/1.1\r\n")


def test_least_payload(spark, tmp_path):
    frame = spark.createDataFrame([(1, "u", "ab"), (2, "u", "ab"), (3, "u", "abc"), (4, "u", "abc")], "page_id long, url string, html string")
    warc.write_archives(frame, f"{tmp_path}/out", least=3)
    kinds = {r.record_id[-1]: r.record_type for r in warc.read_archives(spark, f"{tmp_path}/out").collect()}
    assert kinds == {"1": "response", "2": "response", "3": "response", "4": "revisit"}


def test_repeated_ids(spark, tmp_path):
    """A row is a revisit by its own payload, not by that of another row of its id."""
    rows = [(1, "u", "copy"), (2, "u", "copy"), (2, "v", "another"), (2, "w", "copy"), (1, "x", "copy")]
    warc.write_archives(spark.createDataFrame(rows, "page_id long, url string, html string"), f"{tmp_path}/out")
    back = warc.read_archives(spark, f"{tmp_path}/out").collect()
    got = sorted((r.url, r.record_type, r.refers_to, r.payload_digest) for r in back)
    copy, another = warc.base32_sha1(b"copy"), warc.base32_sha1(b"another")
    refers = "urn:page:1"
    assert got == [
        ("u", "response", None, copy),
        ("u", "revisit", refers, copy),
        ("v", "response", None, another),
        ("w", "revisit", refers, copy),
        ("x", "response", None, copy),
    ]


def archive(packed):
    records = [warc.record(f"urn:page:{i}", "2024-01-01T00:00:00Z", b"payload %d" % i * 20, warc.base32_sha1(b"payload %d" % i * 20)) for i in range(6)]
    return [warc.member(r) for r in records] if packed else records


def read(data):
    salvage = warc.Salvage(data)
    return [f["warc-record-id"][-2] for _, f, _ in salvage.records()], salvage.gaps


@pytest.mark.parametrize("packed", [True, False])
@pytest.mark.parametrize("kind", ["flip", "cut", "noise", "lost start", "end"])
def test_salvage(packed, kind):
    parts = archive(packed)
    start = sum(map(len, parts[:2]))
    hurt = bytearray(parts[2])
    if kind == "flip":
        hurt[len(hurt) // 2 + 20] ^= 0xFF
    elif kind == "cut":
        hurt = hurt[: len(hurt) // 2]
    elif kind == "lost start":
        hurt = hurt[30:]
    elif kind == "noise":
        hurt = bytearray(b"\x1f\x8b\x08 no member, WARC/1.1 no line " * 5)
    else:
        parts = parts[:3]
        hurt = hurt[:-40]
    found, gaps = read(b"".join([*parts[:2], bytes(hurt), *parts[3:]]))
    assert found == list("01" if kind == "end" else "01345")
    # A line end left at the start of the damage counts as padding.
    assert [(a, b) for a, b, _ in gaps] in ([(start + n, start + len(hurt))] for n in (0, 1)) and gaps[0][2]


def test_whole_file_gzip_and_clean_files():
    data = b"".join(archive(False))
    assert read(gzip.compress(data)) == (list("012345"), [])
    assert read(data) == (list("012345"), []) and read(b"") == ([], []) and read(b"\r\n\r\n") == ([], [])
    half = gzip.compress(data)[:-30]
    found, gaps = read(half)
    assert found == list("012345")[: len(found)] and len(gaps) == 1


def test_digest_is_checked():
    bad = warc.record("urn:page:7", "2024-01-01T00:00:00Z", b"x", warc.base32_sha1(b"y"))
    found, gaps = read(b"".join([archive(False)[0], bad, archive(False)[1]]))
    assert found == ["0", "1"] and gaps[0][2] == "payload digest differs"
