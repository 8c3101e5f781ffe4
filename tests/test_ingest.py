import json

import pytest
from pyspark.sql import functions as F

from sonoledger.operators.ingest import (
    detections_with_labels,
    enrich_payloads,
    explode_detections,
    ingest,
    read_detections,
)
from sonoledger.schemas import DETECTIONS
from sonoledger.sources.labels import fetch_labels, list_label_dirs, read_raw_labels
from sonoledger.sources.manifests import manifest_index, read_manifest
from sonoledger.sources.payloads import count_unreadable, scan_payload_text

HEADER = "recording_id,chunk_id,source_path,start_ms,end_ms,overlap_ms,sha256,notes\n"


def put(path, content):
    path.parent.mkdir(parents=True, exist_ok=True)
    path.write_text(content if isinstance(content, str) else json.dumps(content))
    return str(path)


def rows(df, *cols):
    return [tuple(r[c] for c in cols) for r in df.orderBy(*cols).collect()]


def test_payload_with_offsets(spark, tmp_path):
    put(tmp_path / "rec" / "c1.json", {
        "chunk_id": "chunk_a", "recording_id": "rec1", "source_path": "/x/chunk_a.wav", "status": "ok",
        "chunk": {"start_ms": 1000, "end_ms": 2000, "sha256": "abc"}, "runner": "custom",
        "dataset_root": "/x", "model_version": "v1",
        "detections": [{"timestamp_ms": 500, "end_ms": 900, "label": "RUGR", "label_code": "RUGR",
                        "label_name": "Ruffed Grouse", "confidence": 0.9}],
    })
    found = read_detections(spark, str(tmp_path))
    assert found.schema == DETECTIONS
    row = found.first()
    assert (row.absolute_time_ms, row.absolute_end_ms, row.label, row.confidence) == (1500, 1900, "RUGR", 0.9)
    assert (row.chunk_sha256, row.dataset_root, row.model_version, row.source_path) == (
        "abc", "/x", "v1", "/x/chunk_a.wav")


def test_manifest_fills_and_last_row_wins(spark, tmp_path):
    put(tmp_path / "in" / "somewhere" / "chunk_a.json", {"detections": [{"label": "X", "timestamp_ms": 1}]})
    manifest = put(tmp_path / "m.csv", HEADER + (
        "rec_old,chunk_a,/set/audio/old.wav,1,2,0,sha1,\n"
        "rec_manifest,chunk_a,/set/audio/chunk_a.wav,123,456.7,0,sha999,\n"
        ",,/set/audio/none.wav,1,2,0,x,\n"))
    roots = spark.createDataFrame([("/set/",), ("/",), ("/set/other",)], "dataset_root string")
    row = read_detections(spark, str(tmp_path / "in"), manifest, dataset_roots=roots).collect()
    assert len(row) == 1
    row = row[0]
    assert (row.recording_id, row.chunk_start_ms, row.chunk_end_ms, row.chunk_sha256) == (
        "rec_manifest", 123, 456, "sha999")
    assert (row.source_path, row.dataset_root, row.absolute_time_ms) == (
        "/set/audio/chunk_a.wav", "/set", 124)
    assert manifest_index(read_manifest(spark, manifest)).count() == 1


def test_fallbacks_and_placeholders(spark, tmp_path):
    put(tmp_path / "folder" / "c1.json", {"recording_id": "", "status": ""})
    put(tmp_path / "folder" / "c2.json", {"chunk_id": None, "detections": [
        {"label": None, "confidence": None}, {"confidence": "0.5", "timestamp_ms": "NA"}, "odd"]})
    put(tmp_path / "folder" / "c3.json", {"chunk_id": "", "detections": [], "status": "stub"})
    put(tmp_path / "folder" / "c4.json", {"chunk": "odd", "detections": {"a": 1}})
    put(tmp_path / "folder" / "bad.json", "{not json")
    put(tmp_path / "folder" / "list.json", "[1, 2]")
    put(tmp_path / "folder" / "skipped.txt", "{}")
    found = read_detections(spark, str(tmp_path))
    got = {(r.chunk_id, r.label, r.status, r.confidence, r.recording_id) for r in found.collect()}
    assert got == {
        ("c1", "none", "unknown", None, "folder"),
        (None, "unknown", "ok", None, "folder"),
        (None, "unknown", "ok", 0.5, "folder"),
        ("", "none", "stub", None, "folder"),
        ("c4", "none", "unknown", None, "folder"),
    }
    assert found.filter("chunk_id IS NULL").count() == 3
    counts = count_unreadable(scan_payload_text(spark, str(tmp_path))).first()
    assert (counts.files, counts.unreadable) == (6, 2)


def label_csv(*lines):
    return "filename,start_time,end_time,class_name,class_code,score\n" + "".join(l + "\n" for l in lines)


def test_label_fallback(spark, tmp_path):
    raw = tmp_path / "raw"
    put(raw / "w1" / "HawkEars_labels.csv", label_csv(
        "w1.wav,0.1,0.4,White-throated,WTSP,0.92", "other.wav,0,1,N,C,0.1", ",2.0,3.0,Name only,,",
        "/deep/w1.wav,9,bad,,,x"))
    put(raw / "w2" / "HawkEars_labels.csv", label_csv("other.wav,0,1,N,C,0.1"))
    put(raw / "w3" / "HawkEars_labels.csv", label_csv())
    put(raw / "w5" / "HawkEars_labels.csv", label_csv("w5.wav,1,2,N,C,0.5"))
    docs = {
        "w1": {"status": "", "source_path": "/a/w1.wav"}, "w2": {}, "w3": {"status": "given"}, "w4": {},
        "w5": {"detections": [{"label": "own"}]},
    }
    for name, doc in docs.items():
        put(tmp_path / "in" / "rec" / f"{name}.json",
            {"chunk_id": name, "hawkears_output": f"{raw}/{name}/", "chunk": {"start_ms": 1000}, **doc})
    put(tmp_path / "in" / "rec" / "w6.json", {"chunk_id": "w6", "detections": None})
    found = read_detections(spark, str(tmp_path / "in"), label_root=str(raw))
    assert rows(found, "chunk_id", "label", "status") == [
        ("w1", "Name only", "ok"), ("w1", "WTSP", "ok"), ("w1", "unknown", "ok"),
        ("w2", "none", "no_detections"), ("w3", "none", "given"), ("w4", "none", "no_output"),
        ("w5", "own", "ok"), ("w6", "none", "unknown"),
    ]
    hit = found.filter("label = 'WTSP'").first()
    assert (hit.timestamp_ms, hit.end_ms, hit.absolute_time_ms, hit.confidence) == (100, 400, 1100, 0.92)
    assert {r.label_dir.rsplit("/", 1)[1] for r in list_label_dirs(spark, str(raw)).collect()} == {
        "w1", "w2", "w3", "w5"}


def test_labels_by_default_relative_repeated_and_nameless(spark, tmp_path):
    home = tmp_path / "in" / "rec"
    put(home / "a_out" / "HawkEars_labels.csv", label_csv("a.wav,0,1,Grouse,RUGR,0.9", "b.wav,0,1,Other,O,0.1"))
    put(home / "a_out" / "other_labels.csv", label_csv("a.wav,0,1,Wrong,W,0.9"))
    (home / "a.json").write_text(
        '{"chunk_id": "a.wav", "a_output": "/gone", "recording_id": "x", "recording_id": "r", "hawkears_output": "in/rec/a_out"}')
    (home / "n.json").write_text('{"chunk_id": null, "hawkears_output": "./in/rec/a_out/"}')
    found = read_detections(spark, str(tmp_path / "in"), label_base=str(tmp_path))
    got = {(r.chunk_id, r.recording_id, r.label, r.status) for r in found.collect()}
    assert got == {("a.wav", "r", "RUGR", "ok"), (None, "rec", "RUGR", "ok"), (None, "rec", "O", "ok")}
    assert found.count() == 3


def test_labels_lie_where_payloads_say(spark, tmp_path):
    """Folders outside the payload tree, with a scheme, empty, large, or not there."""

    far = tmp_path / "far"
    put(far / "x" / "HawkEars_labels.csv", label_csv("a.wav,0,1,Wren,WREN,0.5", '"a.wav",2,3,"Wren, two",W2,', "b.wav,0,1,Owl,OWL,0.4"))
    put(far / "e" / "HawkEars_labels.csv", "")
    put(far / "h" / "HawkEars_labels.csv", label_csv(*[f"h.wav,{i},{i + 1},N,C{i},0.1" for i in range(9000)]))
    put(far / "plain", "a file, no folder")
    named = {"a.wav": f"file://{far}/x/", "b.wav": f"{far}//x", "e.wav": f"{far}/e", "h.wav": f"{far}/h", "g.wav": f"{far}/gone",
             "p.wav": f"{far}/plain", "s.wav": f"file://{far}/x"}
    for name, folder in named.items():
        put(tmp_path / "in" / "r" / f"{name}.json", {"chunk_id": name, "hawkears_output": folder})
    found = read_detections(spark, str(tmp_path / "in"))
    assert found.filter("chunk_id = 'h.wav'").count() == 9000
    assert rows(found.filter("chunk_id <> 'h.wav'"), "chunk_id", "label", "status") == [
        ("a.wav", "W2", "ok"), ("a.wav", "WREN", "ok"), ("b.wav", "OWL", "ok"), ("e.wav", "none", "no_detections"),
        ("g.wav", "none", "no_output"), ("p.wav", "none", "no_output"), ("s.wav", "none", "no_detections")]
    # A scan below a root that the payloads do not name finds nothing for them.
    assert {r.status for r in read_detections(spark, str(tmp_path / "in"), label_root=str(tmp_path / "in")).collect()} == {"no_output"}


def test_a_label_file_that_cannot_be_read_is_an_error(spark, tmp_path):
    (tmp_path / "d" / "HawkEars_labels.csv").mkdir(parents=True)
    put(tmp_path / "in" / "r" / "a.json", {"hawkears_output": str(tmp_path / "d")})
    with pytest.raises(Exception, match="directory"):
        read_detections(spark, str(tmp_path / "in")).collect()


def test_each_folder_is_opened_once(spark, tmp_path):
    put(tmp_path / "d" / "HawkEars_labels.csv", label_csv("a,0,1,N,C,1"))
    folders = spark.createDataFrame([(str(tmp_path / "d"),)] * 50 + [(None,), (str(tmp_path / "no"),)], "label_dir string")
    got = sorted((r.has_file, r.is_line) for r in fetch_labels(folders).collect())
    assert got == [(False, False), (True, False), (True, True)]


def test_dataset_root_is_found_by_its_marker(spark, tmp_path):
    (tmp_path / "set" / ".datalad").mkdir(parents=True)
    audio = tmp_path / "set" / "audio" / "x"
    put(tmp_path / "in" / "r" / "a.json", {"chunk_id": "a", "source_path": f"{audio}/a.wav"})
    put(tmp_path / "in" / "r" / "b.json", {"chunk_id": "b", "source_path": "/nowhere/b.wav"})
    roots = {r.chunk_id: r.dataset_root for r in read_detections(spark, str(tmp_path / "in")).collect()}
    assert roots == {"a": str(tmp_path / "set"), "b": None}


def test_label_fallback_without_any_file(spark, tmp_path):
    put(tmp_path / "in" / "r" / "a.json", {"hawkears_output": "/gone/a"})
    (tmp_path / "raw").mkdir()
    put(tmp_path / "raw" / "readme.txt", "x")
    found = read_detections(spark, str(tmp_path / "in"), label_root=str(tmp_path / "raw"))
    assert [(r.label, r.status) for r in found.collect()] == [("none", "no_output")]


def test_one_hot_label_folder_against_brute_force(spark):
    """A third of the windows and most label rows share one folder."""

    windows = [(f"w{i}", f"/a/w{i}.wav", "/hot" if i % 3 == 0 else f"/d{i}") for i in range(60)]
    labels = [("/hot", f"w{i % 40}.wav" if i % 10 else "", i) for i in range(300)]
    labels += [(f"/d{i}", f"w{i}.wav", i) for i in range(0, 60, 4)]
    payloads = spark.createDataFrame(
        [(f"/in/{w}.json", w, "r", "p", s, None, None, None, None, 0, 1, None, d, None)
         for w, s, d in windows],
        "file_path string, chunk_id string, recording_id string, parent_dir string, source_path string,"
        " status string, runner string, dataset_root string, model_version string, chunk_start_ms bigint,"
        " chunk_end_ms bigint, chunk_sha256 string, label_dir string, detections array<struct<"
        "timestamp_ms bigint, end_ms bigint, label string, label_code string, label_name string,"
        " confidence double>>")
    table = spark.createDataFrame(labels, "label_dir string, file_name string, timestamp_ms bigint").selectExpr(
        "*", "0L AS end_ms", "'L' AS label", "'c' AS label_code", "'n' AS label_name", "0.5D AS confidence")
    found = detections_with_labels(
        enrich_payloads(payloads), table, table.select("label_dir").distinct())
    want = []
    for w, s, d in windows:
        hits = [t for ld, f, t in labels if ld == d and f in ("", w, s.rsplit("/", 1)[1])]
        want += [(w, t) for t in hits] or [(w, None)]
    got = [(r.chunk_id, r.timestamp_ms) for r in found.collect()]
    key = lambda p: (p[0], p[1] is None, p[1] or 0)
    assert sorted(got, key=key) == sorted(want, key=key)


def test_raw_labels_columns(spark, tmp_path):
    put(tmp_path / "d" / "HawkEars_labels.csv", label_csv("chunk.wav,0.5,1.5,Grouse,RUGR,0.87"))
    row = read_raw_labels(spark, str(tmp_path)).first()
    assert (row.timestamp_ms, row.end_ms, row.confidence, row.file_name) == (500, 1500, 0.87, "chunk.wav")


def test_ingest_writes_exports(spark, tmp_path):
    put(tmp_path / "in" / "r" / "a.json", {"detections": [{"label": "a,b \"q\"", "confidence": 1}]})
    out = ingest(spark, str(tmp_path / "in"), csv_path=str(tmp_path / "csv"),
                 parquet_path=str(tmp_path / "det.parquet"), clustered=True)
    assert out.count() == 1
    text = next((tmp_path / "csv").glob("part-*.csv")).read_text().splitlines()
    assert text[0] == ",".join(DETECTIONS.names)
    assert '"a,b ""q"""' in text[1]


def test_ingest_of_nothing_writes_nothing(spark, tmp_path):
    put(tmp_path / "in" / "r" / "bad.json", "{")
    assert ingest(spark, str(tmp_path / "in"), csv_path=str(tmp_path / "csv"),
                  parquet_path=str(tmp_path / "p")) is None
    assert not (tmp_path / "csv").exists() and not (tmp_path / "p").exists()


def test_explode_keeps_payload_without_manifest(spark, tmp_path):
    put(tmp_path / "in" / "r" / "a.json", {"chunk_id": "zz"})
    manifest = put(tmp_path / "m.csv", HEADER + "rec,other,/s,1,2,0,s,\n")
    row = read_detections(spark, str(tmp_path / "in"), manifest).first()
    assert (row.recording_id, row.chunk_id, row.chunk_start_ms) == ("r", "zz", None)


def test_small_files_are_dealt_over_tasks_by_their_number(spark, tmp_path):
    from workload.proxies import write_files

    files = spark.range(500).coalesce(1).selectExpr(
        "cast(id AS string) AS chunk_id", f"concat('{tmp_path}/in/r', id % 3, '/', id, '.json') AS source_path",
        "cast(concat('{\"chunk_id\": \"c', id, '\"}') AS binary) AS content")
    assert write_files(files, per_task=25) == 20
    assert read_detections(spark, str(tmp_path / "in")).select("chunk_id").distinct().count() == 500


def test_payload_queries_write_from_many_tasks(spark, tmp_path, monkeypatch):
    from workload import ingest as queries

    shares = []

    def counted(files, **options):
        from workload.proxies import write_files

        shares.append(write_files(files, per_task=10))
        return shares[-1]

    monkeypatch.setattr(queries, "write_files", counted)
    spark.range(1, 101).selectExpr(
        "id AS s_suppkey", "concat('S', id) AS s_name", "cast(id % 5 AS int) AS s_nationkey", "id - 50D AS s_acctbal"
    ).coalesce(1).write.parquet(f"{tmp_path}/supplier.parquet")
    assert queries.ingest_exports(spark, str(tmp_path)).count() == 100
    assert queries.payload_file_scan(spark, str(tmp_path)).count() == 100
    assert shares == [10, 10]


def test_folders_are_listed_many_to_a_task(spark, tmp_path):
    for i in range(200):
        put(tmp_path / "in" / f"r{i}" / "a.json", {"chunk_id": f"c{i}"})
    tracker, key = spark.sparkContext.statusTracker(), "spark.sql.sources.parallelPartitionDiscovery.parallelism"
    before, held = set(tracker.getJobIdsForGroup()), spark.conf.get(key)
    assert scan_payload_text(spark, str(tmp_path / "in")).count() == 200
    stages = [s for j in set(tracker.getJobIdsForGroup()) - before for s in tracker.getJobInfo(j).stageIds]
    assert max(tracker.getStageInfo(s).numTasks for s in stages if tracker.getStageInfo(s)) <= 50
    assert spark.conf.get(key) == held


def test_streamed_files_are_of_bounded_length(spark, monkeypatch):
    from workload import telemetry as queries

    assert queries._dealt(spark.range(1000), 4, "id").rdd.getNumPartitions() == 4
    monkeypatch.setattr(queries, "ROWS_PER_FILE", 100)
    assert queries._dealt(spark.range(1000), 4, "id").rdd.getNumPartitions() == 10


def test_a_manifest_is_read_again_only_when_its_files_change(spark, tmp_path, monkeypatch):
    from sonoledger.streaming import ingest as live

    reads = []
    monkeypatch.setattr(live, "read_manifest", lambda s, path: reads.append(path) or read_manifest(s, path))
    listed, out = tmp_path / "m", str(tmp_path / "out")
    put(listed / "a.csv", HEADER + "".join(f"rec,c{i},/s,{i},2,0,s,\n" for i in range(4)))
    for i in range(4):
        put(tmp_path / "in" / f"c{i}.json", {"chunk_id": f"c{i}"})

    def run():
        files = live.payload_stream(spark, str(tmp_path / "in"), 1)
        live.start_ingest(files, out, str(tmp_path / "cp"), str(listed)).awaitTermination()
        return rows(spark.read.parquet(out), "chunk_id", "recording_id", "chunk_start_ms")

    assert run() == [(f"c{i}", "rec", i) for i in range(4)] and len(reads) == 1
    put(listed / "b.csv", HEADER + "rec,c9,/s,9,2,0,s,\n")
    put(tmp_path / "in" / "c9.json", {"chunk_id": "c9"})
    assert run()[-1] == ("c9", "rec", 9) and len(reads) == 2


def test_label_rows_are_shuffled_once(spark):
    """Where no window is nameless, a second pass over all label rows moves none of them."""

    empty = "cast(NULL AS array<struct<timestamp_ms bigint, end_ms bigint, label string, label_code string," \
        " label_name string, confidence double>>)"
    payloads = spark.range(300).selectExpr(
        "'/in/same.json' AS file_path", "concat('w', id) AS chunk_id", "'r' AS recording_id", "'p' AS parent_dir",
        "concat('/a/w', id, '.wav') AS source_path", "cast(NULL AS string) AS status", "'x' AS runner",
        "cast(NULL AS string) AS dataset_root", "cast(NULL AS string) AS model_version", "0L AS chunk_start_ms",
        "1L AS chunk_end_ms", "cast(NULL AS string) AS chunk_sha256", "concat('/d', id div 4) AS label_dir",
        f"{empty} AS detections")
    labels = spark.range(200).selectExpr(
        "concat('/d', id div 4) AS label_dir", "concat('w', id, '.wav') AS file_name", "id AS timestamp_ms",
        "0L AS end_ms", "'L' AS label", "'c' AS label_code", "'n' AS label_name", "0.5D AS confidence")
    held = spark.conf.get("spark.sql.adaptive.enabled")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        found = detections_with_labels(enrich_payloads(payloads), labels, labels.select("label_dir"))
        plan = found._jdf.queryExecution().executedPlan().toString()
        assert not [x for x in plan.splitlines() if "Exchange hashpartitioning(label_dir" in x and "file_name" not in x
                    and "timestamp_ms" in x] and "BroadcastHashJoin [label_dir" in plan
        # Payloads of one path are told apart: those without a row keep their placeholder.
        assert sorted((r.label, r["count"]) for r in found.groupBy("label").count().collect()) == [("L", 200), ("none", 100)]
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", held)
