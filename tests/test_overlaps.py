"""Results that are found without gathering or making pairs, against the pairs themselves."""

import hashlib
import os
import random

import pytest
from pyspark.sql import functions as F

from evidentia import bindings
from evidentia.functions import keys, similarity
from evidentia.operators import calibrate, candidates, linkage
from evidentia.plans import addresses, identity, scoring, silver


@pytest.fixture(scope="module")
def observed(spark):
    rng = random.Random(4)
    pick = lambda *values: rng.choice([None, *values, *values])
    rows = [(k, rng.choice("AB"), pick(1, 2, 3), pick("p", "q"), pick("s", "t"), pick("1", "2"), pick(1, 2), pick(1, 2), pick("HIGH STREET", "THE HIGH STREET")) for k in range(120)]
    return spark.createDataFrame(rows, "key long, source string, identifier int, postcode string, sector string, premise string, unit int, building int, road string")


def rows(df):
    return sorted(map(repr, df.collect()))


def test_registry_of_exclusive_rules(observed):
    hits = candidates.rule_hits(observed)
    found = candidates.candidate_pairs(hits, exclusive=True)
    assert rows(found) == rows(candidates.candidate_pairs(hits))
    assert "key_l" not in "".join(x for x in found._jdf.queryExecution().executedPlan().toString().splitlines() if "Exchange" in x)


@pytest.mark.parametrize("loose", [False, True])
def test_overlaps(observed, monkeypatch, loose):
    monkeypatch.setattr(candidates, "PAIR_TASKS", 2)
    if loose:  # rules that do share pairs
        monkeypatch.setattr(candidates, "_further", lambda p: F.lit(True))
    found = candidates.rule_overlaps(observed)
    assert rows(found) == rows(candidates.exclusion_violations(candidates.rule_hits(observed)))
    assert bool(found.count()) == loose


@pytest.mark.parametrize("kept", ["true", "rule = 'DIRECT_IDENTIFIER'"])
def test_audit_gathers_no_pairs(spark, observed, monkeypatch, kept):
    monkeypatch.setattr(candidates, "PAIR_TASKS", 2)
    monkeypatch.setattr(candidates, "LARGE_BLOCK", 8)
    policy = [p for p in candidates.DEFAULT_POLICY if kept == "true" or p.rule == candidates.DIRECT]
    more = spark.createDataFrame([(None, "B", 1, "p", "s", "1", 1, 1, "LANE"), (5, "A", None, "p", "s", "1", None, 1, "LANE"), (5, "B", 2, "p", "s", "1", None, 1, "LANE")], observed.schema)
    found = candidates.rules_audit(observed.unionByName(more), policy)
    assert rows(found) == rows(candidates.generation_audit(candidates.rule_hits(observed.unionByName(more), policy)))
    assert not any(x in found._jdf.queryExecution().optimizedPlan().toString() for x in ("Expand", "key_l"))


def test_checksum_of_digits(spark):
    for n in (0, 1, 2, 57):
        keys_ = spark.range(n).select(F.nullif(F.concat(F.lit("k"), F.col("id")), F.lit("k3")).alias("k"))
        plain = keys_.agg(F.bit_xor(F.conv(F.substring(F.sha2("k", 256), 1, 15), 16, 10).cast("long"))).first()[0]
        assert keys_.agg(keys.checksum(F.col("k"))).first()[0] == plain


def _most_rows(df):
    """The most rows that a join of the plan made, once it has run."""
    df.collect()
    found, open_ = [0], [df._jdf.queryExecution().executedPlan()]
    while open_:
        node = open_.pop()
        if node.nodeName().startswith("AdaptiveSparkPlan"):
            open_.append(node.executedPlan())
            continue
        if "QueryStage" in node.nodeName():
            open_.append(node.plan())
            continue
        if "Join" in node.nodeName():
            found.append(node.metrics().apply("numOutputRows").value())
        open_ += [node.children().apply(k) for k in range(node.children().size())]
    return max(found)


def test_fan_out_makes_no_pairs(spark):
    row = "postcode string, building string, unit string, road string"
    parsed = spark.createDataFrame([(f"p{k}", "A1", "1", f"u{k % 2}", "OLD HIGH STREET") for k in range(100)] + [("none", "A1", "1", None, None), ("gaps", "A1", "1", "u0", "A  B")], f"parse_key string, {row}")
    sales = spark.createDataFrame([("A1", "1", f"u{k % 4}", ("HIGH STREET", "OLD HIGH STREET", "IGH STREET", None)[k % 4]) for k in range(400)] + [("A1", "1", "u0", ""), ("A1", "1", "u0", "A  B")], row)
    out = addresses.candidate_fanout(parsed, sales)
    assert _most_rows(out) < 2000
    got = {r.parse_key: tuple(r)[1:] for r in out.collect()}
    assert got["p0"] == (100, 200, 0, 100) and got["p1"] == (100, 200, 100, 100)
    assert got["none"] == (0, 0, 0, 0) and got["gaps"] == (1, 2, 1, 2)


def test_weak_labels_make_no_pairs(spark):
    rows = spark.createDataFrame([(f"k{k}", "A1", "1 2 THE HIGH STREET END", ["1", "2"]) for k in range(100)], "key string, postcode string, premise string, numbers array<string>")
    streets = ("High Street", "STREET", "e e", "", "Low Street", None)
    sales = spark.createDataFrame([(f"s{k}", "A1", "2", "1", streets[k % 6]) for k in range(600)], "sale_key string, postcode string, paon string, saon string, street string")
    out = calibrate.weak_label_sample(rows, sales, "w", 200)
    assert _most_rows(out) < 6000  # places where a street may begin, and not 30,000 pairs
    told = [k for k in range(600) if streets[k % 6] is not None and streets[k % 6].upper() in "1 2 THE HIGH STREET END"]
    first = min((f"s{k}" for k in told), key=lambda s: hashlib.sha256(s.encode()).hexdigest())
    assert {(r.key, r.sale_key, r.weak_label_population_count) for r in out.collect()} == {(f"k{k}", first, 100) for k in range(100)}


def test_few_values_are_compared_beforehand(spark):
    df = spark.createDataFrame([("MARTHA", "MARHTA"), ("A", "A"), ("", ""), (None, "A"), ("DIXON", "DICKSONX")], "a string, b string")
    out = similarity.with_similarity(df, "a", "b", "s", df.select("a").union(df.select("b")))
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan and "SortMergeJoin" not in plan
    assert sorted(map(repr, out.collect())) == sorted(map(repr, similarity.with_similarity(df, "a", "b", "s").collect()))


def test_pairs_that_meet_in_blocks(spark):
    """Scores and summaries of pairs made where a block's rows meet are those of pairs joined to their rows, and no pair is shuffled."""
    rng = random.Random(9)
    pick = lambda *values: rng.choice([None, *values])
    made = [(f"u{rng.random()}", rng.choice("AB"), pick("1", "2"), pick("p1", "p2"), pick("s"), f"{rng.choice(['HIGH STREET', 'HIGH STREAT', 'MILL'])} {rng.randint(1, 4)}", pick("7", "8"), pick("FLAT", "HOUSE")) for _ in range(80)]
    made += [(f"v{k}", s, None, "p1", None, p, None, None) for k, (s, p) in enumerate([("A", None), ("B", None), ("A", "MILL"), ("B", "MILL"), ("A", "LONE 9")])]
    data = spark.createDataFrame(made, f"unique_id string, source_dataset string, {', '.join(f'{c} string' for c in scoring.FEATURES)}")
    data = data.withColumn("no", F.nullif(F.regexp_extract("premise_address_comparison", "([0-9]+)$", 1), F.lit("")))
    side = lambda source, name: data.filter(F.col("source_dataset") == source).select("no", F.col("unique_id").alias(name))
    pairs = side("A", "a").join(side("B", "b"), "no").select(F.least("a", "b").alias("key_l"), F.greatest("a", "b").alias("key_r"))
    plain = scoring.scores(pairs.withColumn("candidate_pair_key", scoring.stable_sha256("candidate-pair", "v1", "key_l", "key_r")), data)
    found = scoring.scores_of(scoring.met(data, "no", "A", "B"))
    assert plain.count() > 100 and rows(found) == rows(plain)
    assert "key_l" not in "".join(x for x in found._jdf.queryExecution().executedPlan().toString().splitlines() if "Exchange" in x)
    review = F.lit("REVIEW").alias("decision_outcome")
    assert rows(identity.observation_summary(found.select("*", review))) == rows(identity.observation_summary(plain.select("*", review)))


def test_bridge_by_numbers(spark):
    """As joined by keys, in fewer exchanges; values that differ in which one is null differ."""
    rng = random.Random(2)
    some = [(f"A{k}", rng.randint(1, 40), rng.choice([None, "p"]), rng.choice([None, 5]), rng.choice([None, 5]), None, None, None) for k in range(90)]
    data = spark.createDataFrame([*some, ("X", 99, None, 7, None, None, None, None), ("Y", 99, None, None, 7, None, None, None)], "source_record_key string, uprn long, postcode string, easting long, northing long, lsoa_code string, msoa_code string, lad_code string")
    data = data.withColumn("uprn", F.col("uprn").cast("decimal(20,0)")).withColumn("allocation_key", scoring.stable_sha256("uprn-allocation", "v1", *silver._ALLOCATED))
    plain, found = silver.allocation_bridge(data, silver.allocations(data)), silver.bridged(data)
    assert rows(found.select(*plain.columns)) == rows(plain) and {r.allocation_status for r in plain.collect()} == {"CONFLICT", "EXACT_DUPLICATE", "UNIQUE"}
    count = lambda df: df._jdf.queryExecution().executedPlan().toString().count("Exchange hashpartitioning")
    assert count(found) < count(plain)


def test_cross_pairs_are_dealt(spark, tmp_path):
    """A nation's pairs come from several tasks, and are those of the plain join."""
    spark.range(40).coalesce(1).selectExpr("id AS c_custkey", "int(nullif(id % 3, 2)) AS c_nationkey").write.parquet(f"{tmp_path}/customer.parquet")
    spark.range(5000).coalesce(1).selectExpr("id AS s_suppkey", "int(id % 2) AS s_nationkey").write.parquet(f"{tmp_path}/supplier.parquet")
    found = bindings.QUERIES["candidate_pairs_cross"](spark, str(tmp_path))
    plain = linkage.cross_pairs(spark.read.parquet(f"{tmp_path}/customer.parquet"), spark.read.parquet(f"{tmp_path}/supplier.parquet").withColumnRenamed("s_nationkey", "c_nationkey"), ["c_nationkey"], F.expr("c_custkey % 10 <> s_suppkey % 10"))
    both = [df.agg(F.count("*"), F.sum(F.xxhash64("c_custkey", "s_suppkey", nation).cast("decimal(38,0)"))).first() for df, nation in ((found, "nation"), (plain, "c_nationkey"))]
    assert both[0] == both[1] and both[0][0] > 40_000
    tasks = found.select("nation", F.spark_partition_id().alias("task")).groupBy("nation").agg(F.countDistinct("task").alias("n"))
    assert min(r.n for r in tasks.collect()) > 1


def test_evidence_is_summed_up_in_blocks(spark, tmp_path):
    """As of decisions that are joined to targets, with no pair in an exchange; ids that come twice take that way."""
    parts = [("high st 1", "p1"), ("high st 1", "p2"), ("mill 1", "p1"), ("mill 2", None), ("9", "p3"), ("none", "p1"), (None, "p1")]
    made = [(f"u{k:02}", "AB"[k % 2], str(k % 3) if k % 4 else None, parts[k % 7][1], "s", parts[k % 7][0], "7", "FLAT", f"2020-01-{1 + k % 9:02}") for k in range(60)]
    data = spark.createDataFrame(made, f"unique_id string, source_dataset string, {', '.join(f'{c} string' for c in scoring.FEATURES)}, event_date string")
    data = data.withColumns({"no": F.nullif(F.regexp_extract("premise_address_comparison", "([0-9]+)$", 1), F.lit("")), "identity_run_key": F.lit("r"), "target_hypothesis_key": F.sha2(F.concat_ws("|", "postcode", "premise_address_comparison"), 256)})
    met = lambda df, *more: scoring.met(df, "no", "A", "B", more)
    plain = identity.target_evidence(scoring.scores_of(met(data)), data.select(F.col("unique_id").alias("identity_run_observation_key"), "target_hypothesis_key", "event_date"))
    more = ("target_hypothesis_key", "event_date")
    short = data.withColumn("target_hypothesis_key", F.unhex("target_hypothesis_key"))
    found = identity.met_target_evidence(scoring.scores_of(met(short, *more), keep=["no", *(f"{c}_{s}" for s in "lr" for c in more)]), "no")
    assert plain.count() > 20 and rows(found) == rows(plain)
    assert "key_l" not in "".join(x for x in found._jdf.queryExecution().executedPlan().toString().splitlines() if "Exchange" in x)


@pytest.mark.skipif(not os.path.isdir("/root/testdata/sf0.001"), reason="the driver's tables are not here")
def test_target_evidence_stages_no_pairs(spark, monkeypatch):
    from evidentia import domain_bindings

    staged = []
    monkeypatch.setattr(domain_bindings.store, "stage", lambda df, name, f=domain_bindings.store.stage: staged.append(name) or f(df, name))
    assert bindings.QUERIES["target_evidence"](spark, "/root/testdata/sf0.001").count()
    assert "scores" not in staged
