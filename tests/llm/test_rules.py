"""Quality ledger, decontamination, archives, preference rows and the pipeline on small and odd inputs."""

import hashlib

import pytest

import corpus_pipeline
from starmart.llm import decontamination, preference, quality_ledger, warc
from tests.llm.conftest import ODD, prose


def test_ledger_of_odd_documents(odd, none):
    rows = quality_ledger.verdict(quality_ledger.ledger(odd)).collect()
    assert len(rows) == len(ODD)
    by = {r.doc_id: r for r in rows}
    assert (by[4].n_words, by[5].n_words, by[6].n_words) == (0, 0, 0) and not by[5].kept
    assert by[1].kept and by[8].kept and by[8].n_words == 60_000
    assert by[10].n_repeat_words == by[10].n_words == 180
    assert quality_ledger.ledger(none).count() == 0


def test_ablations(odd, none):
    found = {r.rule: r for r in quality_ledger.ablations(quality_ledger.ledger(odd)).collect()}
    kept = quality_ledger.verdict(quality_ledger.ledger(odd)).where("kept").count()
    assert set(found) == set(quality_ledger.CURRENT.rules)
    assert all(r.kept_without == kept + r.failed_alone and r.failed >= r.failed_alone for r in found.values())
    assert {r.failed for r in quality_ledger.ablations(quality_ledger.ledger(none)).collect()} == {0}


def edit_distance_within(pattern, text):
    """Least edit distance of the pattern to a substring, by the plain recurrence."""
    row = [0] * (len(text) + 1)
    for p in pattern:
        new = [row[0] + 1]
        for k, t in enumerate(text):
            new.append(min(row[k] + (p != t), row[k + 1] + 1, new[k] + 1))
        row = new
    return min(row)


def test_distance_is_the_plain_recurrence():
    pattern = decontamination.normal(prose(8))
    for text in (pattern, pattern[:20] + "zz" + pattern[22:] + " more", "no such words", pattern[3:] + pattern, "", "x" + pattern[:-4]):
        got, _ = decontamination.least_distance(decontamination.masks_of(pattern), len(pattern), text)
        assert got == edit_distance_within(pattern, text)


def test_contaminated_documents(spark, odd, none):
    item = prose(20, 3, 400)
    edited = item[:30] + "#" + item[31:60] + item[62:]
    docs = [(1, f"{prose(30)}\n{item.upper()} {prose(30)}"), (2, f"{prose(10)} {edited}"), (3, prose(90)), (4, None), (None, item)]
    benchmark = spark.createDataFrame([(7, item), (8, ""), (9, None), (None, prose(15, 9, 700))], "item_id long, text string")
    rows = spark.createDataFrame(docs, "doc_id long, text string")
    for block in (10, 4_000_000):
        found = decontamination.contaminated(rows, benchmark, block_chars=block).collect()
        assert {(r.doc_id, r.item_id, r.distance) for r in found} == {(1, 7, 0), (2, 7, 3), (None, 7, 0)}
    assert decontamination.contaminated(odd, benchmark.limit(0)).count() == 0
    assert decontamination.contaminated(none, benchmark).count() == 0


def test_registered_decontamination_finds_what_brute_force_does(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    benchmark = spark.read.parquet("/root/testdata/sf0.001/benchmark.parquet")
    found = {(r.doc_id, r.item_id) for r in decontamination.contaminated(docs, benchmark).collect()}
    items = [(r.item_id, decontamination.normal(r.text)) for r in benchmark.collect()]
    exact = {(d.doc_id, i) for d in docs.collect() for i, t in items if t in decontamination.normal(d.text)}
    assert exact and exact <= found


def test_archives(spark, folder):
    big, small = "<p>é</p>" * 40_000, "<p>x</p>"
    pages = [(3, "http://a", big), (1, "http://b\r\nX: y", big), (2, None, small), (4, "u", small), (5, "u", None), (None, "u", big)]
    pages += [(6, "u", big), (6, "u", big)]
    rows = spark.createDataFrame([(*p, "x") for p in pages], "page_id long, url string, html string, digest string")
    warc.write_archive(rows, f"{folder}/w", chunk_bytes=1000)
    assert spark.read.parquet(f"{folder}/w").where("length(data) > 1000").count() == 0
    found = sorted(warc.read_archive(spark, f"{folder}/w").collect(), key=lambda r: (r.page_id is None, r.page_id))
    assert len(found) == len(pages)
    raw = big.encode()
    for r in found:
        body = {2: small.encode(), 4: small.encode(), 5: b""}.get(r.page_id, raw)
        assert (r.payload_bytes, r.payload_digest) == (len(body), hashlib.sha256(body).hexdigest())
    kinds = [(r.page_id, r.record_type, r.refers_to) for r in found]
    assert kinds == [
        (1, "response", None), (2, "response", None), (3, "revisit", 1), (4, "response", None), (5, "response", None),
        (6, "revisit", 1), (6, "revisit", 1), (None, "revisit", 1),
    ]
    warc.write_archive(rows.limit(0), f"{folder}/none")
    assert warc.read_archive(spark, f"{folder}/none").count() == 0


def test_damaged_archives_are_refused(spark, folder):
    from pyspark.sql import functions as F

    rows = spark.createDataFrame([(1, "u", prose(500))], "page_id long, url string, html string")
    warc.write_archive(rows, f"{folder}/w", chunk_bytes=500)
    stored = spark.read.parquet(f"{folder}/w")
    stored.withColumn("data", F.when(F.col("chunk") == 2, F.repeat(F.lit("x"), 500).cast("binary")).otherwise(F.col("data"))).write.parquet(f"{folder}/bad")
    with pytest.raises(Exception, match="damaged"):
        warc.read_archive(spark, f"{folder}/bad").count()
    stored.where("chunk <> 2").write.parquet(f"{folder}/gap")
    with pytest.raises(Exception, match="chunk is missing"):
        warc.read_archive(spark, f"{folder}/gap").count()


def test_preference_rows(spark):
    turns = "array<struct<role: string, text: string>>"
    same, other = [("user", "hi"), ("assistant", "yes")], [("user", "hi"), ("assistant", "no"), ("user", "why")]
    pairs = [(1, same, other), (2, same, same), (3, [], other), (4, None, None), (5, [("user", "a")], [("user", "b")])]
    rows = spark.createDataFrame(pairs, f"pair_id long, chosen {turns}, rejected {turns}")
    by = {r.pair_id: r for r in preference.preference_rows(rows).collect()}
    assert [by[k].n_prompt for k in (1, 2, 3, 4, 5)] == [1, 2, 0, 0, 0]
    assert by[1].prompt == "<|user|>\nhi\n<|end|>\n" and by[1].chosen == "<|assistant|>\nyes\n<|end|>\n"
    (span,) = by[1].chosen_learned
    assert by[1].chosen[span["from"] : span["to"]] == "yes\n<|end|>\n"
    (span,) = by[1].rejected_learned
    assert by[1].rejected[span["from"] : span["to"]] == "no\n<|end|>\n"
    assert by[2].chosen == by[2].rejected == "" and by[5].chosen_learned == []


def test_conversations_with_nulls(spark):
    rows = [(1, 1, "assistant", "b"), (1, 0, "user", None), (1, 2, None, "c"), (1, 3, "assistant", "d"), (None, 0, "user", "x"), (2, 0, "user", "y")]
    turns = spark.createDataFrame([(*r, 9) for r in rows], "conv_id long, turn int, role string, text string, turns int")
    held = preference.conversations(turns)
    assert {r.conv_id: [tuple(t) for t in r.turns] for r in held.collect()} == {
        1: [("user", ""), ("assistant", "b"), ("", "c"), ("assistant", "d")],
        2: [("user", "y")],
    }
    assert [r.n_prompt for r in preference.preference_rows(preference.stale_replies(held)).collect()] == [3]


def test_pipeline_on_odd_documents(spark, odd, none, folder):
    from pyspark.sql import functions as F

    spark.createDataFrame([(7, prose(20, 3, 400))], "item_id long, text string").write.parquet(f"{folder}/benchmark.parquet")
    for start in (odd, none):
        docs = start.withColumn("n_chars", F.length("text"))
        for k, (name, stage) in enumerate(corpus_pipeline.STAGES):
            out = stage(spark, docs, folder)
            if k < len(corpus_pipeline.STAGES) - 1:
                assert out.columns == docs.columns
            at = f"{folder}/{start is odd}-{name}"
            out.write.parquet(at)
            docs = spark.read.parquet(at)
        assert (docs.count() > 0) == (start is odd)


def test_pipeline_stages_take_effect(spark):
    sf_dir = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    packed = corpus_pipeline.run(spark, sf_dir)
    left = {r.doc_id for r in packed.select("doc_id").distinct().collect()}
    kept = quality_ledger.verdict(quality_ledger.ledger(docs.select("doc_id", "text")))
    assert left <= {r.doc_id for r in kept.where("kept").collect()}
    leaks = decontamination.contaminated(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet")).select("doc_id").distinct()
    assert 0 < len(left) < docs.count() and not left & {r.doc_id for r in leaks.collect()}
