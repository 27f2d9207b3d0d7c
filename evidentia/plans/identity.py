"""Identity plans: both sources as one population, what is scored, target hypotheses, gated hypotheses, clusters.

A run is named by its key; every row carries it. Nothing is ever promoted or joined into one entity: hypotheses say what
awaits a review.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from evidentia.functions.keys import stable_sha256
from evidentia.functions.text import complete_number_designator, normalise_address, unit_identifier
from evidentia.operators.linkage import endpoints
from evidentia.plans.silver import property_class


class IncompletePublication(RuntimeError):
    """Candidates and decisions of the run are not one to one."""


_COMPONENTS = ("unit_identifier_comparison", "building_number_designator", "road_comparison")


def _sale_side(sales: DataFrame) -> DataFrame:
    """Sales name the parts of their address themselves."""
    return sales.select(
        F.lit("PPD").alias("source_dataset"), "source_record_key", F.col("transaction_id").alias("source_natural_key"), F.col("transfer_date").alias("event_date"),
        normalise_address(F.concat_ws(" ", "paon", "saon", "street", "locality")).alias("premise_address_comparison"), "postcode", "postcode_parse_status",
        F.lit(None).cast("decimal(20,0)").alias("uprn"), "property_type", unit_identifier(F.col("saon")).alias(_COMPONENTS[0]),
        complete_number_designator(F.col("paon")).alias(_COMPONENTS[1]), normalise_address(F.col("street")).alias(_COMPONENTS[2]), F.lit("PPD_STRUCTURED_FIELDS").alias("address_component_method"),
    )


def _certificate_side(certificates: DataFrame, parses: DataFrame) -> DataFrame:
    """Certificates have them where their address was routed to the parser."""
    parsed = parses.select("source_record_key", *_COMPONENTS, F.lit(True).alias("__routed"))
    both = certificates.join(parsed, "source_record_key", "left")
    return both.select(
        F.lit("EPC_CERTIFICATE").alias("source_dataset"), "source_record_key", F.col("certificate_number").alias("source_natural_key"), F.col("inspection_date").alias("event_date"),
        normalise_address(F.concat_ws(" ", "address1", "address2", "address3")).alias("premise_address_comparison"), "postcode", "postcode_parse_status",
        F.col("uprn").cast("decimal(20,0)").alias("uprn"), "property_type", *_COMPONENTS, F.when(F.col("__routed"), "LIBPOSTAL").otherwise("NOT_ROUTED").alias("address_component_method"),
    )


def observations(sales: DataFrame, certificates: DataFrame, parses: DataFrame, run_key: str) -> DataFrame:
    """Both sources in one schema, with what makes a row eligible and how complete its parts are."""
    both = _sale_side(sales).unionByName(_certificate_side(certificates, parses))
    premise = F.col("premise_address_comparison")
    whole = F.col(_COMPONENTS[0]).isNotNull() & F.col(_COMPONENTS[1]).isNotNull() & F.col(_COMPONENTS[2]).isNotNull()
    status = F.when(F.col("address_component_method") == "NOT_ROUTED", "NOT_ROUTED").when(whole, "COMPLETE").otherwise("INCOMPLETE")
    eligibility = (
        F.when(premise.isNull(), "INELIGIBLE_MISSING_ADDRESS")
        .when(F.col("postcode_parse_status") == "MISSING", "INELIGIBLE_MISSING_POSTCODE")
        .when(F.col("postcode_parse_status") == "INVALID", "INELIGIBLE_INVALID_POSTCODE")
        .otherwise("ELIGIBLE")
    )
    return both.select(
        stable_sha256("observation", "v1", "source_dataset", "source_record_key").alias("identity_observation_key"),
        stable_sha256("run-observation", "v1", F.lit(run_key), "source_dataset", "source_record_key").alias("identity_run_observation_key"),
        F.lit(run_key).alias("identity_run_key"),
        *both.columns,
        F.nullif(F.regexp_extract(premise, "(^| )([0-9]+[A-Z]?)", 2), F.lit("")).alias("premise_number_token"),
        F.left(F.col("postcode"), F.length("postcode") - 2).alias("postcode_sector"),
        status.alias("address_component_status"),
        eligibility.alias("eligibility_status"),
        (eligibility == "ELIGIBLE").alias("is_identity_eligible"),
    )


def address_parses(requests: DataFrame, results: DataFrame, run_key: str) -> DataFrame:
    """Parse requests of one run with the results of their inputs."""
    mine = requests.filter(F.col("parse_run_key") == run_key).select("source_record_key", "parser_input_key", "selection_reason")
    return mine.join(results.select("parser_input_key", "parse_status", *_COMPONENTS), "parser_input_key")


def scoring_input(population: DataFrame, blocks: DataFrame) -> DataFrame:
    """Eligible observations with their class of property and the status of their candidate block, where they have one."""
    block = ["postcode", *_COMPONENTS[:2]]
    status = blocks.select(*block, F.col("admission").alias("__block"))
    found = population.filter("is_identity_eligible").join(status, block, "left")
    return found.select(
        F.col("identity_run_observation_key").alias("unique_id"), "identity_run_key", "identity_observation_key", "source_dataset", "source_natural_key", "premise_address_comparison", "premise_number_token",
        *_COMPONENTS, "address_component_method", "address_component_status", "postcode", "postcode_sector", F.col("uprn").cast("string").alias("uprn"), "event_date",
        F.coalesce("__block", F.lit("NOT_APPLICABLE")).alias("candidate_block_status"), property_class(F.col("source_dataset"), F.col("property_type")).alias("property_class"),
    )


def _supplied() -> Column:
    return (F.col("source_dataset") == "EPC_CERTIFICATE") & F.col("uprn").isNotNull()


def target_key() -> Column:
    """The key of what a row of the population, or a scoring row, points at."""
    by_number = stable_sha256("target-hypothesis", "v1", "identity_run_key", F.lit("SUPPLIED_UPRN"), "uprn")
    by_address = stable_sha256("target-hypothesis", "v1", "identity_run_key", F.lit("ADDRESS_SIGNATURE"), "postcode", "premise_address_comparison")
    return F.when(_supplied(), by_number).otherwise(by_address)


def target_hypotheses(population: DataFrame) -> DataFrame:
    """What an eligible observation points at: the number it was supplied with, else its postcode and premise."""
    supplied = _supplied()
    value = F.when(supplied, F.col("uprn").cast("string")).otherwise(F.concat_ws("|", "postcode", "premise_address_comparison"))
    return population.filter("is_identity_eligible").select(
        target_key().alias("target_hypothesis_key"), "identity_run_key", "identity_run_observation_key", "identity_observation_key", "source_dataset", "event_date",
        F.when(supplied, "SUPPLIED_UPRN").otherwise("ADDRESS_SIGNATURE").alias("target_hypothesis_type"), value.alias("target_hypothesis_value"), F.lit("EVIDENCE_GROUP_ONLY").alias("target_hypothesis_status"),
    )


def publication_gaps(candidates: DataFrame, decisions: DataFrame) -> DataFrame:
    """Pairs that break one decision a candidate: without a decision, without a candidate, or with several."""
    sides = candidates.select("candidate_pair_key", F.lit(1).alias("c"), F.lit(0).alias("d")).unionByName(decisions.select("candidate_pair_key", F.lit(0).alias("c"), F.lit(1).alias("d")))
    counts = sides.groupBy("candidate_pair_key").agg(F.sum("c").alias("c"), F.sum("d").alias("d"))
    gap = F.when(F.col("d") == 0, "CANDIDATE_WITHOUT_DECISION").when(F.col("c") == 0, "DECISION_WITHOUT_CANDIDATE").when(F.col("d") > 1, "DUPLICATE_DECISION")
    return counts.select("candidate_pair_key", gap.alias("gap")).filter("gap IS NOT NULL")


def observation_summary(decided: DataFrame) -> DataFrame:
    """Per observation: candidates, those in review, the best weight, and its pair and counterpart (the least pair of equals).

    decided: key_l, key_r, candidate_pair_key, match_weight, decision_outcome.
    """
    ends = endpoints(decided, ["candidate_pair_key", "match_weight", "decision_outcome"])
    best = F.min(F.struct((-F.col("match_weight")).alias("w"), "candidate_pair_key", "other"))
    found = ends.groupBy("key").agg(F.count("*").alias("candidate_count"), F.count_if(F.col("decision_outcome") == "REVIEW").alias("review_candidate_count"), best.alias("b"))
    return found.select("key", "candidate_count", "review_candidate_count", (-F.col("b.w")).alias("top_match_weight"), F.col("b.candidate_pair_key").alias("top_candidate_pair_key"), F.col("b.other").alias("top_counterpart_key"))


def hypotheses(population: DataFrame, candidates: DataFrame, decided: DataFrame) -> DataFrame:
    """A hypothesis for every eligible observation; raises unless candidates and decisions are one to one."""
    gaps = publication_gaps(candidates, decided).groupBy("gap").agg(F.count("*").alias("n")).orderBy("gap").collect()
    if gaps:
        raise IncompletePublication(", ".join(f"{r.gap}: {r.n}" for r in gaps))
    summary = observation_summary(decided).withColumnRenamed("key", "identity_run_observation_key")
    return hypotheses_of(population.filter("is_identity_eligible"), summary)


def hypotheses_of(eligible: DataFrame, summary: DataFrame) -> DataFrame:
    """A hypothesis for every eligible observation by its summary, where its decisions were made of the candidates themselves."""
    run = ["identity_run_key", "identity_run_observation_key"]
    found = eligible.select(*run, "identity_observation_key").join(summary, run[1], "left")
    return found.select(
        stable_sha256("hypothesis", "v1", *run).alias("identity_hypothesis_key"), stable_sha256("singleton-cluster", "v1", *run).alias("identity_cluster_key"), *run, "identity_observation_key",
        F.when(F.col("candidate_count").isNull(), "SINGLETON_NO_CANDIDATE").otherwise("UNRESOLVED_REVIEW").alias("hypothesis_outcome"),
        F.coalesce("candidate_count", F.lit(0)).alias("candidate_count"), F.coalesce("review_candidate_count", F.lit(0)).alias("review_candidate_count"),
        "top_candidate_pair_key", "top_counterpart_key", "top_match_weight", F.lit("NOT_PROMOTED_UNCALIBRATED").alias("registry_promotion_status"),
    )


def cluster_membership(found: DataFrame) -> DataFrame:
    """One cluster an observation; none has several members."""
    status = F.when(F.col("hypothesis_outcome") == "SINGLETON_NO_CANDIDATE", "SINGLETON").otherwise("UNRESOLVED_REVIEW")
    return found.select(
        "identity_cluster_key", "identity_hypothesis_key", "identity_run_key", "identity_run_observation_key", "identity_observation_key",
        F.lit("SINGLETON").alias("cluster_kind"), F.lit(False).alias("is_registry_promoted"), status.alias("membership_status"),
    )


def target_evidence(decided: DataFrame, targets: DataFrame) -> DataFrame:
    """Per observation and target of its counterparts: support, span of their events, best weight and pair.

    targets: identity_run_observation_key, target_hypothesis_key, event_date. Both ends of a pair go through one aggregation.
    """
    ends = endpoints(decided, ["candidate_pair_key", "match_weight"])
    to = targets.select(F.col("identity_run_observation_key").alias("other"), "target_hypothesis_key", "event_date")
    best = F.min(F.struct((-F.col("match_weight")).alias("w"), "candidate_pair_key"))
    found = ends.join(to, "other").groupBy("key", "target_hypothesis_key").agg(
        F.count("*").alias("supporting_candidate_count"), F.countDistinct("other").alias("counterpart_observation_count"), F.min("event_date").alias("first_counterpart_event_date"),
        F.max("event_date").alias("last_counterpart_event_date"), best.alias("b"),
    )
    return _evidence(found)


def met_target_evidence(scored: DataFrame, block: str) -> DataFrame:
    """As `target_evidence` of pairs that come once each, with their block and both ends' target_hypothesis_key (as bytes) and
    event_date: an end's pairs are all in one block, so they are summed up where they meet and none is shuffled."""
    end = lambda s, o: F.struct(F.col(f"key_{s}").alias("key"), F.col(f"target_hypothesis_key_{o}").alias("target"), F.col(f"event_date_{o}").alias("event_date"))
    ends = scored.select(block, F.explode(F.array(end("l", "r"), end("r", "l"))).alias("e"), "candidate_pair_key", "match_weight")
    best = F.min(F.struct((-F.col("match_weight")).alias("w"), "candidate_pair_key"))
    found = ends.groupBy(block, F.col("e.key").alias("key"), F.col("e.target").alias("target")).agg(
        F.count("*").alias("supporting_candidate_count"), F.count("*").alias("counterpart_observation_count"), F.min("e.event_date").alias("first_counterpart_event_date"),
        F.max("e.event_date").alias("last_counterpart_event_date"), best.alias("b"),
    )
    return _evidence(found.withColumn("target_hypothesis_key", F.lower(F.hex("target"))))


def _evidence(found: DataFrame) -> DataFrame:
    return found.select(
        stable_sha256("target-alternative", "v1", "key", "target_hypothesis_key").alias("target_alternative_key"), "key", "target_hypothesis_key", "supporting_candidate_count",
        "counterpart_observation_count", "first_counterpart_event_date", "last_counterpart_event_date", (-F.col("b.w")).alias("top_match_weight"), F.col("b.candidate_pair_key").alias("top_candidate_pair_key"),
    )


def current(rows: DataFrame, publications: DataFrame, runs: DataFrame, run_key: str, mode: str = "NATIONAL") -> DataFrame:
    """Scores or decisions of the current run's one published model, of a run that succeeded in that mode."""
    model = ["identity_run_key", "scoring_run_id", "model_sha256"]
    done = runs.filter((F.col("run_mode") == mode) & (F.col("run_status") == "SUCCEEDED")).select(*model)
    published = publications.filter(F.col("identity_run_key") == run_key).select(*model).join(done, model, "left_semi")
    return rows.join(F.broadcast(published), model, "left_semi")


def run_manifest(known: DataFrame, run: DataFrame) -> DataFrame:
    """Registered runs with this one, once."""
    return known.unionByName(run.join(known.select("identity_run_key"), "identity_run_key", "left_anti").select(*known.columns))


def promotions(found: DataFrame, decided: DataFrame, clusters: DataFrame) -> DataFrame:
    """What an uncalibrated run must not have: accepted edges, outcomes other than review, promoted or joined clusters."""
    bad = lambda df, key, broken, what: df.filter(broken).select(F.col(key).alias("record_key"), F.lit(what).alias("violation"))
    out = bad(decided, "candidate_pair_key", F.col("is_accepted_edge") | (F.col("decision_outcome") != "REVIEW"), "DECISION")
    out = out.unionByName(bad(found, "identity_hypothesis_key", F.col("registry_promotion_status") != "NOT_PROMOTED_UNCALIBRATED", "HYPOTHESIS"))
    return out.unionByName(bad(clusters, "identity_cluster_key", F.col("is_registry_promoted") | (F.col("cluster_kind") != "SINGLETON"), "CLUSTER"))
