import bz2
import json

import pytest
from pyspark.sql import functions as F

from corpusloom.sources import files, sinks, wiki


def write(path, text):
    path.parent.mkdir(parents=True, exist_ok=True)
    path.write_text(text, encoding="utf-8")
    return str(path)


def test_discovery(tmp_path):
    for n in ("b/x.JSONL", "a.txt", "c.md", "skip.csv", "d.json"):
        write(tmp_path / n, "x")
    assert [p.rsplit("/", 1)[1] for p in files.discover(tmp_path)] == ["a.txt", "x.JSONL", "c.md", "d.json"]
    assert [len(x) for x in files.discover_by_kind(tmp_path)] == [2, 2]
    assert files.discover_by_kind(tmp_path / "none") == ([], [])
    with pytest.raises(FileNotFoundError):
        files.discover(tmp_path / "none")


def test_json_lines(spark, tmp_path):
    p = write(tmp_path / "a.jsonl", '{"content":"x","id":7}\n\n  \nbroken\n[{"content":"y"}]\n"s"\n{"content":5}\n{"content":null,"id":"n"}\n{"content":"z","source_file":"own"}\n')
    rows = files.read_json_lines(spark, p)
    assert rows.count() == 4
    got = files.entries(spark, str(tmp_path)).where("content is not null").orderBy("content").collect()
    assert [(r["id"], r["content"], r["source_file"].rsplit("/", 1)[-1]) for r in got] == [("7", "x", "a.jsonl"), (None, "z", "own")]
    with pytest.raises(Exception, match="not a JSON object"):
        files.read_json_lines_strict(spark, p).select("record").collect()


def test_json_documents_and_texts(spark, tmp_path):
    write(tmp_path / "a.json", '[{"content":"x"}, 5, {"content":"y"}]')
    write(tmp_path / "b.json", '{"content":"z","k":{"n":[1]}}')
    write(tmp_path / "c.json", "7")
    write(tmp_path / "book" / "d.e.txt", "text\n")
    write(tmp_path / "empty.md", "")
    got = files.entries(spark, str(tmp_path)).orderBy("content").collect()
    assert [r["content"] for r in got] == ["text\n", "x", "y", "z"]
    assert (got[0]["id"], got[0]["title"]) == ("d.e", "d.e")
    assert json.loads(got[3]["record"])["k"] == {"n": [1]}
    assert files.read_texts(spark, str(tmp_path / "book" / "d.e.txt")).first()["book"] == "book"


def test_keys(spark, tmp_path):
    p = write(tmp_path / "keys.txt", "a\t1\n\n b \nb\n　\n")
    assert sorted(r[0] for r in files.read_keys(spark, p).collect()) == ["a\t1", "b"]
    assert files.read_keys(spark, str(tmp_path / "none.txt")).count() == 0


PAGES = """<mediawiki xmlns="http://www.mediawiki.org/xml/export-0.11/"><page><title>織 A</title><ns>0</ns><id>007</id>
<revision><text> first 織織織 [[x]]</text></revision><revision><text>second</text></revision></page>
<page><title>B</title><id>2</id><revision><text>織 と 織</text></revision></page>
<page><title>C</title><ns>0</ns><id>3</id><revision><text>織織織</text></revision></page>
<page><title>-D</title><ns>0</ns><id>4</id><revision><text>織織織</text></revision></page>
<page><title>織 E</title><ns>1</ns><id>5</id><revision><text>織</text></revision></page>
<page><title>織 F</title><ns>0</ns><id>6</id><revision><text>  #REDIRECT [[x]]</text></revision></page>
<page><title>織 G</title><ns>0</ns><id>8</id><revision><text>{{only}}</text></revision></page></mediawiki>"""


@pytest.mark.parametrize("packed", [False, True])
def test_wiki_dump(spark, tmp_path, packed):
    p = tmp_path / ("d.xml.bz2" if packed else "d.xml")
    p.write_bytes(bz2.compress(PAGES.encode()) if packed else PAGES.encode())
    pages = wiki.read_dump(spark, str(p))
    assert pages.where("id = '007'").first()["text"] == " first 織織織 [[x]]"
    assert pages.where("id = '2'").first()["ns"] == "0"
    found = wiki.articles(pages, "織", 3)
    assert sorted((r["id"], r["content"], r["match_reason"]) for r in found.collect()) == [("007", "first 織織織 x", "title"), ("3", "織織織", "content")]
    assert wiki.match_counts(found).first().asDict() == {"title_matches": 1, "content_matches": 1, "total": 2}


def test_upload(spark, tmp_path):
    rows = ['{"text":"a","copyright_mitigation":true,"source_file":"s","extra":[1]}', '{"text":"b","copyright_mitigation":" TRUE "}', '{"text":"c","copyright_mitigation":false}', '{"text":"d"}']
    write(tmp_path / "in" / "all.jsonl", "\n".join(rows))
    counts = sinks.stage_upload(spark, str(tmp_path / "in"), str(tmp_path / "out"), splits=True).collect()
    assert [tuple(r) for r in counts] == [("all.jsonl", 2)]
    got = sorted(r["value"] for r in spark.read.text(str(tmp_path / "out" / "all.jsonl")).collect())
    assert [json.loads(x) for x in got] == [{"extra": [1], "text": "a"}, {"text": "b"}]
    with pytest.raises(FileNotFoundError):
        sinks.stage_upload(spark, str(tmp_path), str(tmp_path / "o"))


def test_images_and_boxes(spark, tmp_path):
    (tmp_path / "a.png").write_bytes(b"\x89PNG")
    assert files.read_images(spark, str(tmp_path)).first()["image"] == "iVBORw=="
    assert files.crop_box((100, 100, 500, 1000), 1000, 500) == (90, 45, 550, 500)
    assert files.read_any(spark, write(tmp_path / "t.csv", "a,b\n1,2")).select(F.col("record")).first()[0] == "a,b\n1,2"


def test_crop_images(spark):
    import base64
    import zlib

    import numpy as np

    from corpusloom.functions import png

    rng = np.random.default_rng(0)
    head = b"\0\0\0\0\0\0\0\0\x08\x02\0\0\0"
    pixels = rng.integers(0, 256, (20, 10, 3)).astype(np.uint8)
    data = png.write(pixels, {b"IHDR": head})
    assert (png.read(data)[0] == pixels).all()
    # the five filters, by their definition
    rows, above = [], np.zeros(30, int)
    for y, line in enumerate(pixels.reshape(20, 30).astype(int)):
        left, corner = np.r_[0, 0, 0, line[:-3]], np.r_[0, 0, 0, above[:-3]]
        p = left + above - corner
        near = np.where((abs(p - left) <= abs(p - above)) & (abs(p - left) <= abs(p - corner)), left, np.where(abs(p - above) <= abs(p - corner), above, corner))
        rows.append(np.r_[y % 5, (line - (0, left, above, (left + above) // 2, near)[y % 5]) % 256])
        above = line
    filtered = png.write(pixels, {b"IHDR": head}).replace(zlib.compress(np.c_[np.zeros(20, int), pixels.reshape(20, 30)].astype(np.uint8).tobytes()), zlib.compress(np.array(rows).astype(np.uint8).tobytes()))
    assert (png.read(filtered)[0] == pixels).all()
    df = spark.createDataFrame([(1, bytearray(data), [0.0, 0.0, 500.0, 500.0]), (2, None, [0.0] * 4), (3, bytearray(b"x"), [0.0, 0.0, 9.0, 9.0]), (4, bytearray(data), None)], "i int, content binary, box array<double>")
    got = {r["i"]: r["image"] for r in files.crop_images(df, margin=0.0).collect()}
    assert (png.read(base64.b64decode(got[1]))[0] == pixels[:10, :5]).all() and got[2] is got[3] is got[4] is None
