import base64
import hashlib
import random

import pytest
import zstandard

from starlot.llm import warc


def pages(spark, data):
    return spark.createDataFrame([(*r, 1, 2) for r in data], "page_id bigint, url string, html string, bundle int, frame int")


def brute(data, least=0):
    bodies = [(k, (h or "").encode()) for k, _, h in data]
    out = []
    for k, body in bodies:
        same = [j for j, b in bodies if b == body and j is not None]
        first = min(same) if same and len(body) >= least else None
        revisit = first is not None and k is not None and k != first
        out.append((k, len(body), base64.b32encode(hashlib.sha1(body).digest()).decode(), "revisit" if revisit else "response", first if revisit else None))
    return sorted(out, key=repr)


def corpus():
    rnd = random.Random(1)
    data = [(k, f"http://x/{k}", "".join(rnd.choice("abc é\r\n") for _ in range(rnd.randint(0, 400)))) for k in range(200)]
    data += [(1000 + k, None, "same page") for k in range(120)] + [(500, "u", None), (400, "u\r\nWARC-Type: x", ""), (None, "u", "same page"), (7000, "u", "WARC/1.1\r\n\r\n" * 9)]
    data += [(8000, "u", "x" * 700_000), (1000, "again", "same page")]
    return data


@pytest.mark.parametrize("least", [0, 5, 100])
def test_records_against_brute_force(spark, tmp_path, least):
    folder = str(tmp_path / "w")
    index = warc.write_archives(pages(spark, corpus()).repartition(3), folder, least_bytes=least, frame_bytes=2000, bundle_bytes=20_000)
    assert index.count() == len(corpus()) and index.select("bundle").distinct().count() >= 3
    got = warc.read_archives(spark, folder)
    rows = got.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to").collect()
    assert sorted(map(tuple, rows), key=repr) == brute(corpus(), least)
    bodies = {k: (h or "").encode() for k, _, h in corpus()}
    assert all(bytes(r.block) == bodies[r.page_id] for r in got.where("record_type = 'response'").collect())


def test_bundles_are_plain_and_seekable(spark, tmp_path):
    folder = str(tmp_path / "w")
    index = warc.write_archives(pages(spark, corpus()).coalesce(1), folder, frame_bytes=3000).orderBy("frame", "offset").collect()
    path = tmp_path / "w" / "bundles" / index[0].bundle
    data = path.read_bytes()
    whole = zstandard.ZstdDecompressor().stream_reader(data, read_across_frames=True).read()
    with open(path, "rb") as stream:
        table = warc.read_seek_table(stream, len(data))
    assert len(whole) == sum(x[2] for x in table) and whole.count(b"WARC-Record-ID: ") == len(index)
    starts = [sum(x[2] for x in table[:k]) for k in range(len(table))]
    for r in index[::17]:
        fields, _ = warc.read_record(whole[starts[r.frame] + r.offset:][:r.length])
        assert fields["WARC-Record-ID"] == f"<urn:page:{'none' if r.page_id is None else r.page_id}>" and table[r.frame][:2] == (r.frame_start, r.frame_bytes)


def test_empty_table(spark, tmp_path):
    folder = str(tmp_path / "w")
    assert warc.write_archives(pages(spark, []), folder).count() == 0
    assert warc.read_archives(spark, folder).count() == 0
