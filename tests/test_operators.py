import datetime
import json
import zipfile
from dataclasses import replace

import pytest
from pyspark.sql import functions as F

from evidentia.operators import calibrate, facts, linkage, profile, quality, store
from evidentia.plans import addresses
from evidentia.sources import archive, csv
from evidentia.sources.manifest import Manifest, ManifestConflict
from evidentia.streaming import incremental


def test_conflict_classes(spark):
    df = spark.createDataFrame([("a", "x"), ("b", "x"), ("b", "x"), ("c", "x"), ("c", "y"), ("d", "x"), ("d", None)], "k string, v string")
    got = {r.k: r.conflict_status for r in profile.natural_key_classes(df, ["k"], F.col("v")).collect()}
    assert got == {"a": "UNIQUE", "b": "EXACT_DUPLICATE", "c": "CONFLICT", "d": "CONFLICT"}


def test_parent_status(spark):
    parents = spark.createDataFrame([("a", "UNIQUE"), ("b", "EXACT_DUPLICATE"), ("c", "CONFLICT")], "k string, conflict_status string")
    children = spark.createDataFrame([("a",), ("b",), ("c",), ("d",)], "k string")
    assert {r.k: r.parent_status for r in facts.parent_status(children, parents, "k").collect()} == {"a": "MATCHED", "b": "MATCHED", "c": "CONFLICTING", "d": "ORPHAN"}


def test_every_row_is_accepted_or_quarantined(spark):
    df = spark.createDataFrame([(1, "g", None), (2, "g", 5), (3, "h", -1)], "id int, g string, v int")
    rules = [quality.Rule("MISSING", "v IS NULL"), quality.Rule("NEGATIVE", "v < 0"), quality.Rule("THIRD", "id = 3")]
    events = quality.quarantine(df, F.col("id"), rules, ["id", "v"])
    assert sorted((r.record_key, r.rule_code) for r in events.collect()) == [("1", "MISSING"), ("3", "NEGATIVE"), ("3", "THIRD")]
    assert [r.raw_record for r in events.filter("record_key = '1'").collect()] == ['{"id":1,"v":null}']
    result = quality.reconcile(df, quality.accepted(df, rules), events.withColumn("g", F.when(F.col("record_key") == "1", "g").otherwise("h")), "g")
    assert {r.reconciliation_status for r in result.collect()} == {"PASSED"}
    assert quality.unique(df, ["g"]).count() == 1 and quality.not_null(df, "v").count() == 1 and quality.accepted_values(df, "g", ["g"]).count() == 1


def test_append_upsert_and_pointer(spark, tmp_path):
    path = f"file://{tmp_path}/t"
    rows = lambda *x: spark.createDataFrame(list(x), "k int, v string")
    for _ in range(2):
        store.append_if_absent(rows((1, "a"), (2, "b")), path, ["k"])
    store.append_if_absent(rows((2, "z"), (3, "c")), path, ["k"])
    assert sorted(map(tuple, spark.read.parquet(path).collect())) == [(1, "a"), (2, "b"), (3, "c")]
    before = store.read(spark, path)
    store.upsert(rows((2, "z")), path, ["k"])
    assert sorted(map(tuple, store.read(spark, path).collect())) == [(1, "a"), (2, "z"), (3, "c")]
    assert before.count() == 3
    for v in "xyz":
        store.upsert(rows((2, v)), path, ["k"])
        store.append_if_absent(rows((2, "n"), (4, v)), path, ["k"])
    assert sorted(map(tuple, store.read(spark, path).collect())) == [(1, "a"), (2, "z"), (3, "c"), (4, "x")]
    assert len([*(tmp_path / "t").glob("version-*")]) == 2
    store.delete_rows(spark, path, "v", ["c"])
    assert store.read(spark, path).count() == 3
    with pytest.raises(ValueError):
        store.append_if_absent(rows((9, "a"), (9, "b")), path, ["k"])
    for key in ("x", "y"):
        store.publish_pointer(spark, f"file://{tmp_path}/p", "current", key)
    assert [tuple(r) for r in store.read(spark, f"file://{tmp_path}/p").collect()] == [("current", "y")]


def test_publication_states():
    assert [store.publication_action(*s) for s in ((0, 0, 5), (5, 5, 5), (3, 3, 5), (5, 3, 5), (5, 0, 5))] == ["PUBLISH", "NO_OP", "INCOMPLETE_BLOCKED", "INCOMPLETE_BLOCKED", "REACTIVATION_BLOCKED"]
    assert [store.prepublication_action(*s) for s in ((0, 0, 5), (0, 3, 5), (0, 5, 5), (5, 0, 5))] == ["INCOMPLETE_BLOCKED", "INCOMPLETE_BLOCKED", "PASS", "PASS"]


def test_ledger(spark):
    schema = "k int, run_key string, valid_from timestamp, valid_to timestamp, is_current boolean"
    t0, t1 = datetime.datetime(2020, 1, 1), datetime.datetime(2021, 1, 1)
    ledger = spark.createDataFrame([(1, "r1", t0, None, True)], schema)
    proposed = spark.createDataFrame([(1,), (2,)], "k int")
    new = store.publish_assignments(ledger, proposed, "k", "r2", 2, t1)
    assert sorted((r.k, r.run_key, r.is_current) for r in new.collect()) == [(1, "r1", False), (1, "r2", True), (2, "r2", True)]
    assert quality.interval_violations(new, "k").count() == 0
    assert store.publish_assignments(new, proposed, "k", "r2", 2, t1) is new
    with pytest.raises(store.PublicationBlocked):
        store.publish_assignments(new, proposed, "k", "r2", 3, t1)


def test_labels_and_thresholds(spark):
    labelled = spark.createDataFrame([(20.0, True), (-5.0, False)], "w double, y boolean")
    assert calibrate.threshold_sweep(labelled, "w", "y").count() == 61
    with pytest.raises(ValueError):
        calibrate.evaluate(labelled, "w", "y")
    sampled = spark.createDataFrame([("a",), ("b",)], "sample_id string")
    old = spark.createDataFrame([("a", "MATCH", True)], "sample_id string, label string, is_active boolean")
    new = spark.createDataFrame([("a", "NO_MATCH")], "sample_id string, label string")
    got = calibrate.import_labels(old, new, sampled, ["MATCH", "NO_MATCH"])
    assert sorted((r.label, r.is_active) for r in got.collect()) == [("MATCH", False), ("NO_MATCH", True)]
    with pytest.raises(ValueError):
        calibrate.import_labels(old, spark.createDataFrame([("c", "MATCH")], new.schema), sampled, ["MATCH"])


def test_training_recovers_agreement(spark):
    rows = [(1, 1, 1, 1)] * 80 + [(1, 2, 1, 2)] * 900 + [(1, 1, 1, 2)] * 20
    pairs = spark.createDataFrame(rows, "a_l int, a_r int, b_l int, b_r int")
    make = lambda c: linkage.Comparison(c, f"{c}_l IS NULL OR {c}_r IS NULL", (linkage.Level("EXACT", f"{c}_l = {c}_r", 0.9, 0.1), linkage.Level("ELSE", "true", 0.1, 0.9)))
    u = {c: {"EXACT": 0.02, "ELSE": 0.98} for c in "ab"}
    m, prior, _ = linkage.estimate_m(pairs, [make("a"), make("b")], u, 0.1)
    assert m["a"]["EXACT"] > 0.9 and m["b"]["EXACT"] > 0.7 and 0.05 < prior < 0.15


def test_csv_keeps_empty_text_and_order(spark, tmp_path):
    file = tmp_path / "x.csv"
    file.write_text('a,b,c\n"x ""q""",,1\n"line\nend",é,\n')
    csv.check_header(str(file), ["a", "b", "c"])
    rows = csv.read_strict(spark, f"file://{file}", csv.raw_names(str(file)), header=True).collect()
    assert [tuple(r) for r in rows] == [('x "q"', "", "1", 1), ("line\nend", "é", "", 2)]
    with pytest.raises(csv.HeaderDrift):
        csv.check_header(str(file), ["a", "b"])


def zipped(path, **members):
    with zipfile.ZipFile(path, "w") as z:
        for name, content in members.items():
            z.writestr(name.replace("_", "-") + ".csv" if name != "notes" else "notes.txt", content)
    return f"file://{path}"


def test_archives_load_once(spark, tmp_path):
    state = Manifest(spark, f"file://{tmp_path}/control")
    release, run, write = state.register_release("p", "d", "2026", year="2026"), state.start_run("load"), archive.into_tables(f"file://{tmp_path}/raw")
    load = lambda path, routes=archive.ROUTES["certificates"]: archive.load_archive(spark, path, routes, state, release, run, write, f"file://{tmp_path}/scratch")
    certificates, recommendations = "ID,Cost\n1,\n2,GBP 100 - GBP 350\n", "ID,Item\n1,x\n"
    first = zipped(tmp_path / "a.zip", certificates_2026=certificates, recommendations_2026=recommendations, notes="no route")
    assert load(first) == {"loaded": 2, "skipped": 0} and load(first) == {"loaded": 0, "skipped": 2}
    rows = spark.read.parquet(f"{tmp_path}/raw/raw_certificate").orderBy("source_row_number").collect()
    assert [(r.id_raw, r.cost_raw) for r in rows] == [("1", ""), ("2", "GBP 100 - GBP 350")] and rows[0].source_record_key != rows[1].source_record_key
    assert not [*(tmp_path / "scratch").glob("members*/*")]
    # the same members repacked, and one under another name
    assert load(zipped(tmp_path / "b.zip", recommendations_2027=recommendations, certificates_2026=certificates)) == {"loaded": 0, "skipped": 2}
    files, held = state.table("files").collect(), state.table("containers").collect()
    assert sorted((f.file_kind, f.status, f.observed_rows) for f in files) == [("ZIP_ARCHIVE", "LOADED", 3), ("ZIP_ARCHIVE", "LOADED", 3), ("ZIP_MEMBER", "LOADED", 1), ("ZIP_MEMBER", "LOADED", 2)]
    assert len(held) == 4 and spark.read.parquet(f"{tmp_path}/raw/raw_certificate").count() == 2
    # a manifest of a later driver knows all of it
    assert Manifest(spark, f"file://{tmp_path}/control").register_release("p", "d", "2026", year="2026")["release_id"] == release["release_id"]
    with pytest.raises(ManifestConflict):
        state.register_release("p", "d", "2026", year="2027")
    with pytest.raises(ManifestConflict):
        load(first, [replace(r, contract="v2") for r in archive.ROUTES["certificates"]])
    with pytest.raises(ManifestConflict):
        load(first, archive.ROUTES["certificates"][:1])
    state.end_run(run)
    assert state.table("runs").first().status == "SUCCEEDED"


def test_failed_members_are_tried_again(spark, tmp_path):
    state = Manifest(spark, f"file://{tmp_path}/control")
    release, run, kept = state.register_release("p", "d", "2026"), state.start_run("load"), []
    path = zipped(tmp_path / "a.zip", certificates_2025="ID\n1\n", certificates_2026="")

    def write(target, rows):
        kept.append(target)
        return rows.count()

    for _ in range(2):
        with pytest.raises(ValueError, match="empty file"):
            archive.load_archive(spark, path, archive.ROUTES["certificates"], state, release, run, write, f"file://{tmp_path}/scratch")
    status = {f.file_name: (f.status, f.error is None) for f in state.table("files").collect()}
    assert status == {"a.zip": ("PARTIAL", False), "certificates-2025.csv": ("LOADED", True), "certificates-2026.csv": ("FAILED", False)}
    assert kept == ["raw_certificate"] and state.table("releases").first().status == "PARTIAL"


def test_files_and_their_headers(spark, tmp_path):
    state = Manifest(spark, f"file://{tmp_path}/control")
    release, (route,) = state.register_release("p", "lad", "2025"), archive.ROUTES["districts"]
    got = []

    def write(target, rows):
        got.extend(rows.collect())
        return rows.count()

    good, bad, sale = (tmp_path / f"{n}.csv" for n in ("good", "bad", "sale"))
    good.write_text("LAD25CD,LAD25NM,LAD25NMW,ObjectId\nW06000001,Isle of Anglesey,Ynys Môn,1\nE06000001,Hartlepool,,2\n")
    bad.write_text("LAD25CD,LAD25NM,ObjectId\n")
    assert [archive.load_file(spark, f"file://{good}", route, state, release, "run", write) for _ in range(2)] == ["LOADED", "SKIPPED"]
    assert [(r.lad25nm_raw, r.lad25nmw_raw) for r in got] == [("Isle of Anglesey", "Ynys Môn"), ("Hartlepool", "")] and len({r.source_record_key for r in got}) == 2
    with pytest.raises(csv.HeaderDrift, match="Source header drift"):
        archive.load_file(spark, f"file://{bad}", route, state, release, "run", write)
    assert {f.file_name: f.status for f in state.table("files").collect()} == {"good.csv": "LOADED", "bad.csv": "FAILED"}
    sale.write_text('"{1}","100","2020-01-02 00:00",' + ",".join(['""'] * 13) + "\n")
    got.clear()
    archive.load_file(spark, f"file://{sale}", archive.ROUTES["sales"][0], state, release, "run", write)
    assert got[0].transaction_id_raw == "{1}" and got[0].county_raw == ""
    ids = {f.file_name: f.file_id for f in state.table("files").collect()}
    counts = [(ids["good.csv"], 2, 1, 1, "PASSED"), (ids["sale.csv"], 1, 1, 0, "PASSED")]
    schema = "file_id string, observed_rows long, accepted_rows long, quarantined_rows long, reconciliation_status string"
    with pytest.raises(ManifestConflict):
        state.publish_counts(spark.createDataFrame(counts[:1], schema))
    state.publish_counts(spark.createDataFrame(counts, schema))
    assert {f.file_name: f.accepted_rows for f in state.table("files").collect()} == {"good.csv": 1, "bad.csv": None, "sale.csv": 1}


def test_parse_cache(spark):
    fake = lambda _: [("flat 5", "unit"), ("11", "house_number"), ("high street", "road")]
    got = addresses.components("x", fake)
    assert (got["parse_status"], got["unit_identifier_comparison"], got["building_number_designator"], got["road_comparison"]) == ("COMPLETE", "5", "11", "HIGH STREET")
    assert json.loads(got["ordered_components_json"])[1] == {"ordinal": 2, "value": "11", "label": "house_number"}
    for number, expected in (("12 rear", None), ("11/13", None), ("11 and 13", None), ("brighthampton, 55 - 57", "55-57"), ("5a.", "5A"), ("11ab", None), (None, None)):
        assert addresses.building_number(number) == expected
    assert addresses.components("x", lambda _: [("12 rear", "house_number"), ("a road", "road")])["parse_status"] == "INCOMPLETE"
    requests = spark.createDataFrame([("Flat 5, 11 High Street",), ("Flat 5, 11 High Street",), ("boom",)], "parser_input string")

    def flaky(text):
        if text == "boom":
            raise RuntimeError("no")
        return addresses.rule_parser(text)

    empty = spark.createDataFrame([], addresses.RESULT)
    first = spark.createDataFrame(addresses.parse_distinct(requests, empty, flaky, "v1").collect(), empty.schema)
    assert sorted(r.parse_status for r in first.collect()) == ["COMPLETE", "FAILED"]
    again = addresses.parse_distinct(requests, first, addresses.rule_parser, "v1").collect()
    assert len(again) == 1 and addresses.closure_counts(requests, first, "v1") == (2, 1)


def test_stream_appends_once(spark, tmp_path):
    schema = "k int, v string"
    for name, rows in (("a", [(1, "a"), (2, "b")]), ("b", [(2, "b"), (3, "c")])):
        spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(f"{tmp_path}/in")
        incremental.append_new(spark.readStream.schema(schema).parquet(f"{tmp_path}/in"), f"file://{tmp_path}/out", ["k"], f"{tmp_path}/ck").awaitTermination()
    assert sorted(map(tuple, spark.read.parquet(f"{tmp_path}/out").collect())) == [(1, "a"), (2, "b"), (3, "c")]


def test_artifacts(tmp_path):
    from evidentia.operators import artifacts
    from evidentia.plans.scoring import MODEL

    digest = artifacts.save_model(MODEL, tmp_path / "model.json")
    assert artifacts.load_model(tmp_path / "model.json", digest) == MODEL
    with pytest.raises(artifacts.ArtifactDrift):
        artifacts.load_model(tmp_path / "model.json", "0" * 64)
    with pytest.raises(FileExistsError):
        artifacts.save_model(MODEL, tmp_path / "model.json")
    manifest = artifacts.write_report(tmp_path / "report", {"summary": {"rows": 1}})
    with pytest.raises(FileExistsError):
        artifacts.write_report(tmp_path / "report", {})
    whole = artifacts.directory_fingerprint(tmp_path / "report")
    artifacts.verify_install(manifest | {"": whole}, tmp_path / "report")
    (tmp_path / "report" / "summary.json").write_text("{}")
    assert artifacts.directory_fingerprint(tmp_path / "report") != whole
    for wrong in (manifest, {"missing": whole}):
        with pytest.raises(artifacts.ArtifactDrift):
            artifacts.verify_install(wrong, tmp_path / "report")
    with artifacts.ResourceMonitor(tmp_path, 0.01).running() as seen:
        pass
    assert seen.peak_rss > 1 << 20 and seen.least_free > 0 and seen.elapsed >= 0


def test_transform_pin(spark):
    from evidentia.functions import geo
    from evidentia.operators import artifacts

    def point():
        row = geo.with_lonlat(spark.createDataFrame([(530000.0, 180000.0)], "e double, n double"), F.col("e"), F.col("n")).first()
        return row.lon, row.lat

    artifacts.assert_pinned(point, point(), 1e-9)
    with pytest.raises(artifacts.ArtifactDrift):
        artifacts.assert_pinned(point, (0.0, 51.5))


def test_scores_are_published_once(spark):
    from evidentia.plans import scoring

    pairs = spark.createDataFrame([("p1",), ("p2",)], "candidate_pair_key string")
    none = spark.createDataFrame([], "identity_run_key string")
    found = scoring.publishable(pairs, pairs, none, "run", "s1", "m1", "sha").collect()
    assert len({r.match_score_key for r in found}) == 2 and {r.model_status for r in found} == {"UNCALIBRATED"}
    with pytest.raises(scoring.ScoringBlocked):
        scoring.publishable(pairs, pairs, spark.createDataFrame([("run",)], none.schema), "run", "s1", "m1", "sha")
    for scored in (pairs.limit(1), pairs.union(pairs)):
        with pytest.raises(scoring.ScoringBlocked):
            scoring.publishable(pairs, scored, none, "run", "s1", "m1", "sha")


def test_model_training(spark):
    """Values of the five comparisons are found again: sessions train what they do not block on."""
    from evidentia.plans import scoring

    rows = []
    for k in range(300):
        place = (f"AB{k % 60} 1XY", f"AB{k % 60} 1", f"{k % 50} HIGH STREET {k % 60}", str(k % 50), "HOUSE" if k % 2 else "FLAT")
        rows += [(f"a{k}", str(k), *place), (f"b{k}", str(k), *place[:2], place[2] + ("" if k % 4 else "S"), *place[3:])]
    df = spark.createDataFrame(rows, "unique_id string, uprn string, postcode string, postcode_sector string, premise_address_comparison string, premise_number_token string, property_class string")
    blocked = lambda *on: linkage.self_pairs(df, list(on), "unique_id").select("key_l", "key_r")
    model = scoring.train(df, [(blocked("uprn"), ["uprn"]), (blocked("postcode", "premise_address_comparison"), ["postcode", "premise_address"])], most_pairs=5000)
    levels = {(c.name, x.name): x for c in model for x in c.levels}
    assert model[0] == scoring.MODEL[0]
    assert levels["postcode", "EXACT"].m > 0.9 and levels["postcode", "EXACT"].u < 0.1
    assert 0.6 < levels["premise_address", "EXACT"].m < 0.9 and levels["premise_address", "JARO_WINKLER_GE_0_95"].m > 0.1
    scored = scoring.scores(blocked("uprn").withColumn("candidate_pair_key", F.concat_ws("|", "key_l", "key_r")), df, model)
    assert scored.filter("uprn_comparison_level <> 'EXACT'").count() == 0 and scored.filter("match_probability > 0.99").count() > 200


def test_gate_of_hypotheses(spark):
    from evidentia.plans import identity

    schema = "candidate_pair_key string, key_l string, key_r string, match_weight double, decision_outcome string"
    decided = spark.createDataFrame([("p", "a", "b", 3.0, "REVIEW")], schema)
    population = spark.createDataFrame([(True, "run", x, x) for x in "abc"], "is_identity_eligible boolean, identity_run_key string, identity_run_observation_key string, identity_observation_key string")
    found = identity.hypotheses(population, decided, decided)
    assert sorted((r.identity_run_observation_key, r.hypothesis_outcome, r.candidate_count) for r in found.collect()) == [("a", "UNRESOLVED_REVIEW", 1), ("b", "UNRESOLVED_REVIEW", 1), ("c", "SINGLETON_NO_CANDIDATE", 0)]
    for candidates, decisions in ((decided, decided.limit(0)), (decided.limit(0), decided), (decided, decided.union(decided))):
        with pytest.raises(identity.IncompletePublication):
            identity.hypotheses(population, candidates, decisions)


def test_guards_and_names(spark, tmp_path):
    path = f"file://{tmp_path}/ledger"
    store.forbid_refresh(spark, path, True)
    store.replace(spark.createDataFrame([(1,)], "k int"), path)
    store.forbid_refresh(spark, path, False)
    with pytest.raises(store.RefreshProhibited):
        store.forbid_refresh(spark, path, True)
    store.view(store.read(spark, path), "ledger_view")
    assert store.catalog_columns(spark).filter("table_name = 'ledger_view'").first().column_name == "k"
    assert [store.schema_name(*x) for x in (("Silver ", "t"), (None, "T"), (None, ""))] == ["silver", "t", "main"]
    (tmp_path / "labels.csv").write_text('row,label\n001,MATCH\n002,\n')
    assert [tuple(r) for r in csv.read_labels(spark, f"file://{tmp_path}/labels.csv").collect()] == [("001", "MATCH"), ("002", None)]
    now = datetime.datetime(2026, 1, 1)
    assert store.audited(spark.range(2), now).select("recorded_at").distinct().first()[0] == now


def test_policy_files(spark, tmp_path):
    from evidentia.operators import candidates

    policy = candidates.read_policy(spark)
    assert [p for p in policy if p.enabled] == [p for p in candidates.DEFAULT_POLICY if p.enabled]
    head = candidates.SEED.read_text().splitlines()[0]
    for rows in ("A,1,true,,,true", "A,1,true,,,false\nB,1,true,,,false", "A,1,true,,,false\nA,2,true,,,false"):
        (tmp_path / "p.csv").write_text(f"{head}\n{rows}\n")
        with pytest.raises(ValueError):
            candidates.read_policy(spark, f"file://{tmp_path}/p.csv")


def test_transforms_run_once(spark, tmp_path):
    path, calls = f"file://{tmp_path}/cache", []

    def double(df):
        calls.append(df.count())
        return df.withColumn("y", F.col("x") * 2)

    rows = lambda *x: spark.createDataFrame([(v,) for v in x], "x int")
    assert [facts.transform_once(rows(*x), path, "x", double) for x in ((1, 2, 2), (2, 3), (1, 3))] == [2, 1, 0]
    assert calls == [2, 1, 0] and sorted(map(tuple, store.read(spark, path).collect())) == [(1, 2), (2, 4), (3, 6)]


def test_parse_runs(spark, tmp_path):
    requests = spark.createDataFrame([("Flat 5, 11 High Street",), ("boom",), ("boom",)], "parser_input string")
    folder = f"file://{tmp_path}/parse"

    def flaky(text):
        if text == "boom":
            raise RuntimeError("no")
        return addresses.rule_parser(text)

    with pytest.raises(addresses.ParseIncomplete):
        addresses.parse_run(requests, folder, flaky, "v1")
    assert not store.exists(spark, f"{folder}/published")
    assert addresses.parse_run(requests, folder, addresses.rule_parser, "v1") == {"inputs": 2, "parsed": 1}
    assert addresses.parse_run(requests, folder, addresses.rule_parser, "v1") == {"inputs": 2, "parsed": 0}
    attempts = spark.read.parquet(f"{folder}/attempts").collect()
    assert sorted(a.parse_status for a in attempts) == ["COMPLETE", "FAILED", "INCOMPLETE"] and store.read(spark, f"{folder}/results").count() == 2


def test_moments(spark):
    from evidentia.functions import parse

    raw = ["2020-01-02 03:04", "2020-01-02 03:04:05", " 2020-01-02", "2020-02-30", "x", None]
    got = [r[0] and str(r[0]) for r in spark.createDataFrame([(x,) for x in raw], "x string").select(parse.timestamp_of(F.col("x"))).collect()]
    assert got == ["2020-01-02 03:04:00", "2020-01-02 03:04:05", "2020-01-02 00:00:00", None, None, None]
