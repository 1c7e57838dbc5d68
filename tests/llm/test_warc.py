from __future__ import annotations

import gzip
import hashlib
import os

from llm_fixtures import rows  # noqa: F401
from ledgerloom.llm import warc

DATE = "2024-01-01T00:00:00Z"
PAGES = [
    (1, "http://a.org/x\r\nInjected: 1", "<html lang=en><title>A &amp; B</title><p>One<br>two "
     "<a href='http://b.org/'>link</a><script>var hidden</script><!-- no --></html>"),
    (2, None, None),
    (2, None, None),
    (None, "", "plain &lt;text&gt;"),
]


def records(spark, pages=PAGES):
    df = spark.createDataFrame(pages, "page_id long, url string, html string")
    return warc.responses(df.withColumn("extra", df.page_id), DATE)


def test_records_refer_to_their_response(spark):
    source = {r.page_id: r for r in records(spark).collect()}
    out = warc.derivatives(records(spark), ["page_id"]).collect()
    assert len(out) == 2 * len(PAGES)
    for r in out:
        assert r.refers_to == source[r.page_id].record_id != r.record_id
        assert f"WARC-Refers-To: {r.refers_to}\r\n" in r.header
        assert r.block_digest == "sha256:" + hashlib.sha256(r.block.encode()).hexdigest()
        assert r.content_length == len(r.block.encode())
        if r.warc_type == "metadata":
            for h in source[r.page_id].source_headers:
                assert f"source-{h.name.lower()}: {h.value}\r\n" in r.block
    first = {r.warc_type: r for r in out if r.page_id == 1}
    assert first["conversion"].block == "A & B\nOne\ntwo link"
    assert "outlink: http://b.org/\r\n" in first["metadata"].block
    assert "title: A & B\r\n" in first["metadata"].block
    assert "\r\nInjected" not in first["metadata"].header


def test_other_types_have_metadata_only(spark):
    image = records(spark, PAGES[:1]).selectExpr(
        "* EXCEPT (http_head)",
        "'HTTP/1.1 200 OK\r\nContent-Type: image/png\r\n\r\n' AS http_head",
    )
    assert [r.warc_type for r in warc.derivatives(image, []).collect()] == ["metadata"]


def test_all_references_and_unquoted_links(spark):
    html = (
        "<title>Caf&eacute; &#8217;&#x27; &amp;lt;</title><p>&ouml;&rsquo;&ndash;&euro;&#233;&nbsp;"
        "x &copy; &nosuch; a&b</p><a href=http://c.org/?a=1&amp;b=2>c</a>"
        "<a class=k href='http://d.org/?x=1&copy=2&#38;y=3'>d</a>"
        '<a href="/e f" title=t>e</a>'
    )
    out = warc.derivatives(records(spark, [(1, "http://a.org/", html)]), ["page_id"]).collect()
    block = {r.warc_type: r.block for r in out}
    assert "title: Café ’' &lt;\r\n" in block["metadata"]
    assert block["conversion"] == "Café ’' &lt;\nö’–€é x © &nosuch; a&b\ncde"
    assert [x for x in block["metadata"].split("\r\n") if x.startswith("outlink: ")] == [
        "outlink: http://c.org/?a=1&b=2", "outlink: http://d.org/?x=1&copy=2&y=3", "outlink: /e f",
    ]


def test_nothing(spark):
    assert rows(warc.derivatives(records(spark).limit(0), ["page_id"])) == []


def test_written_files_read_back(spark, tmp_path):
    out = warc.derivatives(records(spark), ["page_id"])
    warc.write_warc(out, str(tmp_path / "w"))
    data = b""
    for f in sorted(os.listdir(tmp_path / "w")):
        if f.endswith(".gz"):
            data += gzip.open(tmp_path / "w" / f).read()
    found, at = [], 0
    while at < len(data):
        head, _, rest = data[at:].partition(b"\r\n\r\n")
        fields = dict(line.split(": ", 1) for line in head.decode().split("\r\n")[1:])
        size = int(fields["Content-Length"])
        found.append((fields["WARC-Record-ID"], rest[:size].decode()))
        assert rest[size : size + 4] == b"\r\n\r\n"
        at += len(head) + 4 + size + 4
    assert sorted(found) == rows(out, "record_id", "block")
