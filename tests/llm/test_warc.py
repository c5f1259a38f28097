from __future__ import annotations

import hashlib

from pyspark.sql import functions as F

from aerolake.llm import warc


def replica(spark, name, contents):
    rows = [(name, i, hashlib.sha256(c).hexdigest(), len(c)) for i, c in enumerate(contents) if c is not None]
    return spark.createDataFrame(rows, "replica string, position long, digest string, length long")


def test_audit_finds_exactly_the_damage(spark):
    first = [f"record {i} {'x' * (i % 7)}".encode() for i in range(300)]
    second = list(first)
    second[5], second[77], second[299] = b"other", None, second[299][:-1] + b"?"
    second.append(b"one more")
    levels = warc.trees(replica(spark, "a", first).unionByName(replica(spark, "b", second)), fanout=4, height=3)
    rows = warc.audit(levels, "a", "b", fanout=4).collect()
    found = {r.node: (r.damage, r.offset) for r in rows if r.level == 0}
    starts = [sum(map(len, first[:i])) for i in range(301)]
    assert found == {
        5: ("resized", starts[5]), 77: ("lost", starts[77]), 299: ("altered", starts[299]), 300: ("extra", starts[300]),
    }
    touched = {5, 77, 299, 300}
    for level in (1, 2, 3):
        assert {r.node for r in rows if r.level == level} == {t // 4**level for t in touched}
        assert all(r.offset == starts[r.first_position] for r in rows if r.level == level)


def test_equal_replicas_need_no_descent(spark):
    rows = replica(spark, "a", [b"x", b"y"])
    same = rows.unionByName(rows.withColumn("replica", F.lit("b")))
    assert warc.audit(warc.trees(same), "a", "b").count() == 0
    assert warc.audit(warc.trees(same.limit(0)), "a", "b").count() == 0


def test_positions_follow_the_order(spark):
    rows = [(i % 50 if i % 9 else None, f"{i * 7919 % 1000}") for i in range(1000)]
    made = warc.positions(spark.createDataFrame(rows, "a long, b string"), ["a", "b"]).collect()
    assert sorted(r.position for r in made) == list(range(1000))
    in_order = [(r.a, r.b) for r in sorted(made, key=lambda r: r.position)]
    assert in_order == sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1]))


def test_records_and_files(spark, tmp_path):
    rows = [(1, "http://a/", "<p>é</p>", "z"), (None, None, None, None), (2, "u", "", "z")]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string, record string")
    made = pages.select(warc.record(F.col("page_id"), F.col("url"), F.col("html")).alias("record"))
    texts = [r.record for r in made.collect()]
    assert texts[0].endswith("Content-Length: 9\r\n\r\n<p>é</p>")
    assert texts[1].endswith("Content-Length: 0\r\n\r\n")
    warc.write(made.coalesce(1), str(tmp_path / "out"))
    (file,) = (tmp_path / "out").glob("*.txt")
    assert file.read_bytes().decode() == "".join(t + "\r\n\r\n" for t in texts)
