"""The jobs from the command line, on files."""

import json
from datetime import datetime, timezone

from tallywatch.__main__ import main
from tallywatch.operators import reports
from tallywatch.plans.training import load_latest, registered, train
from tallywatch.schema import MODEL_NAME, SCORE_REQUEST
from tallywatch.sinks.commits import read_committed
from tallywatch.streaming.polling import start_poll_stream
from tallywatch.streaming.progress import read_progress

START = int(datetime(2024, 1, 1, tzinfo=timezone.utc).timestamp())


def test_stream_train_score_report(spark, tmp_path, capsys):
    landing = tmp_path / "in"
    landing.mkdir()
    lines = [
        json.dumps({"source": "la", "timestamp": START + 600 * i, "area_name": f"A{i % 3}", "crm_cd_desc": "t"})
        for i in range(600)
    ]
    odd = tmp_path / "odd"
    odd.mkdir()
    unusable = ["junk", json.dumps({"source": "la"}), json.dumps({"source": "x", "timestamp": 1})]
    (odd / "1.json").write_text("\n".join([*unusable, lines[0]]) + "\n")
    main(["stream", "--messages", "text", "--path", str(odd), "--out", f"{tmp_path}/odd-out",
          "--checkpoint", f"{tmp_path}/odd-cp", "--once"])
    aside = spark.read.parquet(f"{tmp_path}/odd-out/quarantine")
    assert {(r["reason"], r["message"]) for r in aside.collect()} == {
        ("event time", '{"source": "la"}'), ("source", "junk"), ("source", '{"source": "x", "timestamp": 1}')}
    (landing / "1.json").write_text("\n".join(lines) + "\n")
    out, models = tmp_path / "out", tmp_path / "models"
    main(["stream", "--messages", "text", "--path", str(landing), "--out", str(out),
          "--checkpoint", str(tmp_path / "cp"), "--once"])
    assert spark.read.parquet(f"{out}/raw").count() == 600
    hourly = spark.read.parquet(f"{out}/hourly")
    assert hourly.groupBy().sum("incident_count").first()[0] == 6 * 98

    main(["train", "--hourly", f"{out}/hourly", "--models", str(models)])
    assert spark.read.schema("message string, reason string").parquet(f"{out}/quarantine").count() == 0
    for _ in range(2):  # scoring again replaces the rows
        main(["score", "--models", str(models), "--hourly", f"{out}/hourly", "--out", f"{out}/scored"])
        scored = spark.read.parquet(f"{out}/scored")
        assert scored.count() == hourly.count()
    main(["score", "--models", str(models), "--hourly", f"{out}/hourly", "--out", f"{out}/scored", "--since", "2024-01-03"])
    assert spark.read.parquet(f"{out}/scored").count() == hourly.count()

    series = reports.series_of(spark.read.parquet(f"{out}/scored"))
    flags = [reports.flagged(series, t).filter("is_anomaly").count() for t in (0.3, 0.6)]
    assert flags[0] > flags[1]
    assert reports.score_histogram(series).count() > 2 or flags[0] == hourly.count()

    requests = spark.createDataFrame([(1, "A1", "t", 2, None), (2, None, "t", 2, {"a": 1.0})], SCORE_REQUEST)
    requests.write.json(f"{out}/requests")
    main(["score", "--models", str(models), "--requests", f"{out}/requests", "--out", f"{out}/replies"])
    assert [r["request_id"] for r in spark.read.parquet(f"{out}/replies/answers").collect()] == [1]
    assert [r["request_id"] for r in spark.read.parquet(f"{out}/replies/invalid").collect()] == [2]

    capsys.readouterr()
    main(["report", "--scored", f"{out}/scored", "--location", "A1", "--type", "t", "--as-of", "2024-01-05"])
    assert "total_incidents" in capsys.readouterr().out


def test_states_answers_progress_and_polls(spark, tmp_path):
    landing = tmp_path / "landing" / "source=la" / "day=2024-01-01"
    landing.mkdir(parents=True)
    lines = [
        json.dumps({"dr_no": str(i), "date_rptd": "2024-01-01T05:00:00", "area_name": f"A{i % 3}", "crm_cd_desc": "t"}) for i in range(30)
    ]
    (landing / "1.json").write_text("\n".join(lines) + "\n")
    start_poll_stream(spark, str(tmp_path / "landing"), f"{tmp_path}/poll-cp", fmt="text", path=f"{tmp_path}/messages",
                      as_of=datetime(2024, 1, 2), trigger={"availableNow": True}).awaitTermination()
    sent = [json.loads(r["value"]) for r in spark.read.text(f"{tmp_path}/messages").collect()]
    assert len(sent) == 30 and {r["timestamp"] for r in sent} == {START + 86400} and {r["source"] for r in sent} == {"la"}

    more = [json.dumps({"source": "la", "timestamp": START + 600 * i, "area_name": f"A{i % 3}", "crm_cd_desc": "t"}) for i in range(600)]
    (tmp_path / "more").mkdir()
    (tmp_path / "more" / "1.json").write_text("\n".join(more) + "\n")
    out, models = f"{tmp_path}/out", f"{tmp_path}/models"
    main(["stream", "--messages", "text", "--path", f"{tmp_path}/more", "--out", out, "--checkpoint", f"{tmp_path}/cp",
          "--once", "--progress", f"{tmp_path}/progress"])

    days = sorted(str(r[0]) for r in spark.read.parquet(f"{out}/hourly").select("day").distinct().collect())
    for day in days:
        main(["train", "--hourly", f"{out}/hourly", "--models", models, "--states", f"{tmp_path}/states", "--day", day])
    whole, by_days = train(spark.read.parquet(f"{out}/hourly")).model, load_latest(spark, models)
    assert by_days.forest.nodes.equals(whole.forest.nodes) and by_days.offset == whole.offset
    assert registered(spark, models, MODEL_NAME).count() == len(days)

    requests = spark.createDataFrame([(1, "A1", "t", 2, None), (2, None, "t", 2, {"a": 1.0})], SCORE_REQUEST)
    requests.write.json(f"{out}/requests")
    for _ in range(2):
        main(["answer", "--models", models, "--requests", f"{out}/requests", "--out", f"{out}/answered",
              "--checkpoint", f"{tmp_path}/answer-cp", "--once"])
    for table, wanted in (("answers", 1), ("rejects", 2)):
        found = read_committed(spark, f"{out}/answered", "request_id long", table=table)
        assert [r["request_id"] for r in found.collect()] == [wanted]
    assert {r["query"] for r in read_progress(spark, f"{tmp_path}/progress").collect()} == {"raw", "hourly", "quarantine"}
