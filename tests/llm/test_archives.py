import base64
import hashlib

import pytest

from plumbline.llm import warc

PAGES = "page_id long, url string, html string, payload string, version string"


def rows():
    big = "<p>" + "long " * 30000
    html = ["<p>a</p>", "<p>a</p>", None, "", "é\r\n\r\nWARC/1.1\r\n", big, big, "<p>a</p>", "tail \n\n"]
    out = [(i, None if i == 3 else f"http://h.example/{i} x", h, "clash", None) for i, h in enumerate(html)]
    return [*out, out[0], (None, "http://h.example/n", "<p>a</p>", None, None), (None, None, "only without id", None, None)]


def test_round_trip_through_both_versions(spark):
    got = warc.converted(spark.createDataFrame(rows(), PAGES).repartition(2)).collect()
    assert len(got) == len(rows())
    first = {}
    for i, _, h, *_ in rows():
        if i is not None:
            first[h or ""] = min(i, first.get(h or "", i))
    by_id = {}
    for i, _, h, *_ in rows():
        by_id.setdefault(i, []).append(h or "")
    for r in got:
        h = next(x for x in by_id[r.page_id] if base64.b32encode(hashlib.sha1(x.encode()).digest()).decode() == r.payload_digest)
        assert r.payload_bytes == len(h.encode())
        f = first.get(h)
        again = f is not None and r.page_id != f
        assert (r.record_type, r.refers_to) == (("revisit", f) if again else ("response", None))
    assert len({r.record_id for r in got if r.page_id is not None}) == 9


def test_smaller_payloads_may_stay_responses(spark):
    got = warc.converted(spark.createDataFrame(rows()[:9], PAGES), least_bytes=100).collect()
    assert {r.page_id for r in got if r.record_type == "revisit"} == {6}


def test_no_pages(spark):
    assert warc.converted(spark.createDataFrame([], PAGES)).collect() == []


@pytest.mark.parametrize("version", [1, 2])
def test_arc_is_read_by_declared_lengths(version):
    data = (warc.arc_head(version, "f.arc") + "\n" + warc.arc_record(version, 7, "http://h/a b", "x\n1 2 3\n", "f.arc") + "\n" + warc.arc_record(version, None, "http://h/ü", "", "f.arc") + "\n").encode()
    got = list(warc.arc_rows(data))
    assert [(r["page_id"], r["payload"], r["url"], r["version"]) for r in got] == [(7, b"x\n1 2 3\n", "http://h/a%20b", version), (None, b"", "http://h/%C3%BC", version)]
    with pytest.raises(ValueError):
        list(warc.parse_arc(data[:-20]))
    with pytest.raises(ValueError):
        list(warc.parse_arc(data.replace(b"Archive-date", b"Archive-day!")))


def archive(version, name, records):
    """Bytes of an ARC file of (url, mime, content) records."""
    out = warc.arc_head(version, name).encode() + b"\n"
    extra = b" 200 - - 0 %s" % name.encode() if version == 2 else b""
    for url, mime, content in records:
        out += url + b" 10.0.0.1 20010203040506 " + mime + extra + b" %d\n" % len(content) + content + b"\n"
    return out


@pytest.mark.parametrize("version", [1, 2])
def test_bytes_of_any_encoding_blanks_in_urls_and_records_without_http(spark, tmp_path, version):
    import gzip

    http = b"HTTP/1.0 200 OK\r\nContent-Type: text/html\r\n\r\n"
    image, latin = bytes(range(256)) * 3, "caf\u00e9 \u00fcber".encode("latin-1")
    records = [(b"http://h/a b c", b"text/html; charset=latin-1", http + latin), (b"dns:h", b"text/dns", b"20010203 h A 10.0.0.1\n"), (b"http://h/\xe9", b"image/png", http + image),
               (b"http://h/again", b"image/png", http + image), (b"http://h/empty", b"text/html", http)]
    data = archive(version, "real.arc", records)
    # a member for each part, as archives have them
    (tmp_path / "arc").mkdir()
    (tmp_path / "arc" / "part-0.gz").write_bytes(gzip.compress(data[:120]) + gzip.compress(data[120:]))
    assert warc.convert(spark, str(tmp_path / "arc"), str(tmp_path / "warc")).collect() == []
    blocks = {}
    for f in (tmp_path / "warc").glob("part-*"):
        for head, block in warc.parse_warc(f.read_bytes()):
            blocks[head["warc-type"], head.get("warc-target-uri")] = head, block
    info = blocks.pop(("warcinfo", None))
    assert b"isPartOf: real.arc" in info[1]
    assert {k: v[1] for k, v in blocks.items()} == {
        ("response", "http://h/a b c"): http + latin, ("resource", "dns:h"): records[1][2], ("revisit", "http://h/\u00e9"): http, ("response", "http://h/again"): http + image, ("response", "http://h/empty"): http}
    assert blocks["resource", "dns:h"][0]["content-type"] == "text/dns"
    assert all(h["warc-warcinfo-id"] == info[0]["warc-record-id"] and h["warc-date"] == "2001-02-03T04:05:06Z" for h, _ in blocks.values())
    again, first = blocks["revisit", "http://h/\u00e9"][0], blocks["response", "http://h/again"][0]
    assert (again["warc-refers-to"], again["warc-refers-to-target-uri"]) == (first["warc-record-id"], "http://h/again")
    back = warc.read_warc(spark, str(tmp_path / "warc")).collect()
    assert len(back) == 5 and {r.payload_bytes for r in back} == {len(latin), len(records[1][2]), len(image), 0}


@pytest.mark.parametrize("version", [1, 2])
def test_a_bad_record_among_good_ones(spark, tmp_path, version):
    good = [(b"http://h/%d" % i, b"text/plain", b"content %d" % i) for i in range(4)]
    bad = b"no header at all\nnor here\n"
    data = archive(version, "bad.arc", good[:2]) + bad + archive(version, "bad.arc", good[2:])[:-5]
    with pytest.raises(ValueError):
        list(warc.arc_rows(data))
    rows = list(warc.arc_rows(data, strict=False))
    assert [r["url"] for r in rows if r["defect"] is None] == ["http://h/0", "http://h/1", "http://h/2"]
    lost = [r for r in rows if r["defect"]]
    assert lost[0]["payload"] == bad and lost[1]["payload"].endswith(b" 9\nconte") and len(lost) == 2
    (tmp_path / "arc").mkdir()
    (tmp_path / "arc" / "part-0").write_bytes(data)
    told = warc.convert(spark, str(tmp_path / "arc"), str(tmp_path / "warc"), strict=False)
    assert sorted(bytes(r.payload) for r in told.collect()) == sorted(r["payload"] for r in lost)
    assert warc.read_warc(spark, str(tmp_path / "warc")).count() == 3
