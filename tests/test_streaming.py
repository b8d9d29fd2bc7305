import json

from jobtide.streaming import fronts


def test_arrivals(spark, tmp_path):
    folder, bronze = tmp_path / "in", str(tmp_path / "bronze")
    folder.mkdir()

    def arrive(name, run, *ids):
        doc = {"metadata": {}, "listings": [{"listing_id": i, "source_run_id": run} for i in ids]}
        (folder / name).write_text(json.dumps(doc))
        fronts.ingest_arrivals(spark, str(folder), bronze, str(tmp_path / "cp")).awaitTermination()
        return sorted(r.listing_id for r in spark.read.parquet(bronze).collect())

    assert arrive("raw_listings_1.json", "r1", "a", "b") == ["a", "b"]
    assert arrive("raw_listings_2.json", "r1", "a", "b") == ["a", "b"]
    # two files of one run arrive together: the first one stands for it
    (folder / "raw_listings_9.json").write_text(json.dumps(
        {"metadata": {}, "listings": [{"listing_id": "z", "source_run_id": "r2"}]}))
    assert arrive("raw_listings_3.json", "r2", "a") == ["a", "a", "b"]


def test_alerts(spark, tmp_path):
    pairs, log = tmp_path / "pairs", str(tmp_path / "log")
    ddl = "listing_id string, chat_id string"

    def send(*rows):
        spark.createDataFrame(list(rows), ddl).coalesce(1).write.mode("append").parquet(str(pairs))
        stream = spark.readStream.schema(ddl).parquet(str(pairs))
        fronts.record_alerts(spark, stream, log, str(tmp_path / "cp")).awaitTermination()
        return sorted((r.listing_id, r.chat_id) for r in fronts.read_log(spark, log).collect())

    assert send(("a", "1"), ("a", "1"), ("a", "2")) == [("a", "1"), ("a", "2")]
    assert send(("a", "1"), ("b", "1")) == [("a", "1"), ("a", "2"), ("b", "1")]


def test_alerts_of_other_jobs_and_repeated_batches(spark, tmp_path):
    pairs, log, cp = tmp_path / "pairs", str(tmp_path / "log"), tmp_path / "cp"
    ddl = "listing_id string, chat_id string"

    def told(*rows):
        spark.createDataFrame([(*r, None) for r in rows], fronts.LOG).write.mode("append").parquet(log)

    def send(*rows):
        if rows:
            spark.createDataFrame(list(rows), ddl).coalesce(1).write.mode("append").parquet(str(pairs))
        stream = spark.readStream.schema(ddl).parquet(str(pairs))
        query = fronts.record_alerts(spark, stream, log, str(cp))
        query.awaitTermination()
        return sorted((r.listing_id, r.chat_id) for r in fronts.read_log(spark, log).collect()), query

    # the log of batch jobs is known from the first batch on
    told(("a", "1"))
    assert send(("a", "1"), ("b", "1"))[0] == [("a", "1"), ("b", "1")]
    told(("c", "1"))
    got, query = send(("c", "1"), ("d", "1"), ("b", "1"))
    assert got == [("a", "1"), ("b", "1"), ("c", "1"), ("d", "1")]
    # of the log a batch reads what is new in it, and the pairs that were told are state
    progress = query.lastProgress
    assert len(progress.sources) == 2 and progress.stateOperators[0].numRowsTotal == 4
    assert sum(s.numInputRows for s in progress.sources) <= 6
    # a batch that wrote but was not finished comes again and replaces what it wrote
    done = max((cp / "commits").glob("[0-9]*"), key=lambda p: int(p.name))
    for file in (done, done.with_name(f".{done.name}.crc")):
        file.unlink(missing_ok=True)
    assert send()[0] == got
