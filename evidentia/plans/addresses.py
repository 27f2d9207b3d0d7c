"""Address parsing behind an injectable parser, and its content-addressed cache."""

from __future__ import annotations

import json
import re
import uuid
from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from evidentia.functions.keys import stable_sha256
from evidentia.functions.text import DESIGNATOR, UNITS, first_designator, has_token, normalise_address, only_designator, role_component, unit_identifier

from evidentia.operators import store

Parser = Callable[[str], list[tuple[str, str]]]
_PARSED = (
    "ordered_components_json", "grouped_components_json", "parsed_house", "parsed_house_number", "parsed_unit", "parsed_road",
    "building_number_designator", "unit_identifier_comparison", "road_comparison", "parse_status",
)
RESULT = ", ".join(f"{c} string" for c in ("parse_key", *_PARSED, "error"))


def rule_parser(address: str) -> list[tuple[str, str]]:
    """A plain parser: a unit first, then a house number, then the road."""
    rest = address.strip()
    out = []
    if unit := re.match(rf"(?i)((?:{'|'.join(UNITS)})\s*[0-9A-Z/-]+)[ ,]+", rest):
        out.append((unit[1].lower(), "unit"))
        rest = rest[unit.end() :]
    if number := re.match(r"([0-9]+[A-Za-z]?(?:\s*-\s*[0-9]+[A-Za-z]?)?)[ ,]+", rest):
        out.append((number[1].lower(), "house_number"))
        rest = rest[number.end() :]
    if road := rest.split(",")[0].strip():
        out.append((road.lower(), "road"))
    return out


_ALONE = re.compile(rf"(?<![A-Z0-9]){DESIGNATOR}(?![A-Z0-9])")


def _plain(text: str | None) -> str | None:
    return re.sub(r"[^A-Z0-9]+", " ", (text or "").upper()).strip() or None


def _role(text: str | None, opening: str = "") -> str | None:
    return re.sub(r"[^A-Z0-9/-]+", "", re.sub(opening, "", (text or "").upper().strip())) or None


def building_number(text: str | None) -> str | None:
    """A building's number or range, where it ends the text, alone of its kind and without a slash."""
    upper = (text or "").upper().strip(" ,.")
    found = [*_ALONE.finditer(upper)]
    if len(found) != 1 or "/" in upper or found[0].end() < len(upper):
        return None
    return found[0][0].replace(" ", "")


def components(address: str, parser: Parser) -> dict:
    """What a parser makes of an address: its parts in order, joined by label, and their comparison forms.

    COMPLETE if unit, building number and road are all there, else INCOMPLETE.
    """
    parts = [(str(value), str(label)) for value, label in parser(address)]
    joined: dict[str, str] = {}
    for value, label in parts:
        joined[label] = f"{joined[label]} {value}" if label in joined else value
    unit, building, road = _role(joined.get("unit"), rf"^(?:{'|'.join(UNITS)}) *"), building_number(joined.get("house_number")), _plain(joined.get("road"))
    ordered = [{"ordinal": k, "value": value, "label": label} for k, (value, label) in enumerate(parts, 1)]
    return {
        "ordered_components_json": json.dumps(ordered, ensure_ascii=False), "grouped_components_json": json.dumps(joined, sort_keys=True, ensure_ascii=False),
        **{f"parsed_{label}": joined.get(label) for label in ("house", "house_number", "unit", "road")},
        "building_number_designator": building, "unit_identifier_comparison": unit, "road_comparison": road, "parse_status": "COMPLETE" if unit and building and road else "INCOMPLETE",
    }


def evaluate(rows: DataFrame) -> DataFrame:
    """What a parse got right, by role: rows have parsed_house, parsed_house_number, parsed_unit, parsed_road and the
    expected_house_number, expected_unit and expected_road. No flag is NULL."""
    c = F.col
    number, wanted = only_designator(c("parsed_house_number")), only_designator(c("expected_house_number"))
    whole, wanted_whole = role_component(F.concat_ws(" ", "parsed_house", "parsed_house_number")), role_component(c("expected_house_number"))
    unit, wanted_unit = unit_identifier(c("parsed_unit")), unit_identifier(c("expected_unit"))
    road, wanted_road = normalise_address(c("parsed_road")), normalise_address(c("expected_road"))
    in_unit = first_designator(c("expected_unit"))
    yes = lambda x: F.coalesce(x, F.lit(False))
    named = {"parsed_number_designator": number, "parsed_paon_comparison": whole, "parsed_unit_comparison": unit, "parsed_road_comparison": road}
    flags = {
        "house_number_present": c("parsed_house_number").isNotNull(), "unit_present": c("parsed_unit").isNotNull(), "road_present": c("parsed_road").isNotNull(),
        "house_number_matches_expected": yes(number == wanted), "paon_full_matches_expected": yes(whole == wanted_whole), "unit_matches_expected": yes(unit == wanted_unit),
        "road_matches_expected": yes(road == wanted_road), "road_compatible_with_expected": yes(has_token(road, wanted_road)),
        "role_swap": yes(~wanted.eqNullSafe(in_unit) & wanted.isNotNull() & number.eqNullSafe(in_unit) & (unit == wanted)),
    }
    out = rows.withColumns(named | flags)
    both = c("house_number_matches_expected") & c("unit_matches_expected")
    return out.withColumns({"number_roles_recovered": both, "compatible_candidate_recovered": both & c("road_compatible_with_expected"), "strict_candidate_recovered": both & c("road_matches_expected")})


#: Flags of `evaluate` that a summary counts.
FLAGS = (
    "house_number_present", "unit_present", "road_present", "house_number_matches_expected", "paon_full_matches_expected", "unit_matches_expected", "road_matches_expected",
    "road_compatible_with_expected", "role_swap", "number_roles_recovered", "compatible_candidate_recovered", "strict_candidate_recovered",
)


def summarise(evaluated: DataFrame) -> DataFrame:
    """One row: rows, and each flag's count and rate (NULL without rows), from one aggregation."""
    counts = evaluated.agg(F.count("*").alias("row_count"), *(F.count_if(x).alias(f"{x}_count") for x in FLAGS))
    return counts.select("*", *((F.col(f"{x}_count") / F.nullif(F.col("row_count"), F.lit(0))).alias(f"{x}_rate") for x in FLAGS))


def candidate_fanout(parsed: DataFrame, sales: DataFrame) -> DataFrame:
    """How many sales each parsed address would meet by postcode and building number, by road exact or compatible, with and without the unit.

    parsed: parse_key, postcode, building, unit, road. sales: postcode, building, unit, road. A road is compatible if it is a
    run of words of the parsed one, so each distinct run looks up how many sales have it: no pairs are made.
    """
    block = ["postcode", "building", "run"]
    run = F.col("road").alias("run")
    sold = sales.groupBy("postcode", "building", run).agg(F.count("*").alias("n"))
    sold_unit = sales.groupBy("postcode", "building", run, "unit").agg(F.count("*").alias("n_unit"))
    runs = F.expr("array_distinct(flatten(transform(sequence(1, size(words)), i -> transform(sequence(i, size(words)), j -> array_join(slice(words, i, j - i + 1), ' ')))))")
    asked = parsed.withColumn("words", F.split("road", " ", -1)).withColumn("run", F.explode_outer(runs))
    met = asked.join(sold, block, "left").join(sold_unit, [*block, "unit"], "left")
    exact = F.col("run") == F.col("road")
    total = lambda n, *on: F.coalesce(F.sum(F.when(on[0], F.col(n)) if on else F.col(n)), F.lit(0).cast("long"))
    return met.groupBy("parse_key").agg(
        total("n", exact).alias("exact_road_count"), total("n").alias("compatible_road_count"), total("n_unit", exact).alias("exact_road_unit_count"), total("n_unit").alias("compatible_road_unit_count")
    )


def fanout_summary(fanout: DataFrame, column: str) -> DataFrame:
    """One row: how a fan-out count is spread, by exact quantiles and limits."""
    n = F.col(column)
    return fanout.agg(
        F.lit(column).alias("fanout"), F.count("*").alias("row_count"), F.sum(n).alias("total_pair_count"), F.count_if(n == 0).alias("zero_pair_count"), F.count_if(n > 0).alias("positive_pair_count"),
        F.min(n).alias("minimum"), F.percentile(n, 0.5).alias("median"), F.percentile(n, 0.9).alias("p90"), F.percentile(n, 0.99).alias("p99"), F.max(n).alias("maximum"),
        F.count_if(n > 20).alias("over_20_count"), F.count_if(n > 100).alias("over_100_count"),
    )


def parse_distinct(requests: DataFrame, cache: DataFrame, parser: Parser, contract: str) -> DataFrame:
    """Results for the inputs that the cache has not: each distinct input once, failures as rows with their error."""
    wanted = requests.select("parser_input").distinct().withColumn("parse_key", stable_sha256("address-parse", contract, "parser_input"))
    wanted = wanted.join(cache.filter("error IS NULL").select("parse_key"), "parse_key", "left_anti")

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            rows = []
            for key, text in zip(frame["parse_key"], frame["parser_input"], strict=True):
                try:
                    rows.append({"parse_key": key, **components(text, parser), "error": None})
                except Exception as error:  # a parser's fault is a result of its own
                    rows.append(dict.fromkeys(_PARSED) | {"parse_key": key, "parse_status": "FAILED", "error": str(error)})
            yield pd.DataFrame(rows, columns=[x.split()[0] for x in RESULT.split(", ")])

    return wanted.select("parse_key", "parser_input").mapInPandas(run, RESULT)


def closure_counts(requests: DataFrame, cache: DataFrame, contract: str) -> tuple[int, int]:
    """Distinct inputs, and those with a result."""
    wanted = requests.select("parser_input").distinct().withColumn("parse_key", stable_sha256("address-parse", contract, "parser_input"))
    done = wanted.join(cache.filter("error IS NULL").select("parse_key").distinct(), "parse_key", "left_semi")
    return wanted.count(), done.count()


class ParseIncomplete(RuntimeError):
    """Inputs without a result remain; what was parsed is kept, and nothing is published."""


def parse_run(requests: DataFrame, folder: str, parser: Parser, contract: str) -> dict[str, int]:
    """Parse what no earlier run has, store all outcomes of this one together, and publish the run if every input has a result.

    Tables in folder: `results` by content, `attempts` with each run's outcomes and errors, `published`. Inputs that failed
    are tried again by the next run.
    """
    spark = requests.sparkSession
    results, attempts = f"{folder.rstrip('/')}/results", f"{folder.rstrip('/')}/attempts"
    known = store.read(spark, results) if store.exists(spark, results) else spark.createDataFrame([], RESULT)
    run = str(uuid.uuid4())
    made = store.stage(parse_distinct(requests, known, parser, contract), "parsed")
    made.select(F.lit(run).alias("parse_run_id"), "parse_key", "parse_status", "error").write.mode("append").parquet(attempts)
    store.append_if_absent(made.filter("error IS NULL"), results, ["parse_key"])
    inputs, done = closure_counts(requests, store.read(spark, results), contract)
    if done < inputs:
        raise ParseIncomplete(f"{inputs - done} of {inputs} inputs have no result")
    store.publish_pointer(spark, f"{folder.rstrip('/')}/published", contract, run)
    return {"inputs": inputs, "parsed": made.count()}
