"""Typed observations from raw sources: sales, reference codes, allocations and their bridge, fatal rules, parse routes.

Raw tables have text columns named `<field>_raw` and `source_record_key`; every other column is passed through. A plan
here is a projection and a filter over one scan, but for the joins that are named.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from evidentia.functions.keys import stable_sha256
from evidentia.functions.parse import band, strict_integer, strict_unsigned
from evidentia.functions.text import UNITS, blank_to_null, full_match, normalise_address, postcode, postcode_status, trimmed
from evidentia.operators.profile import conflict_classes
from evidentia.operators.quality import Rule, accepted, quarantine

#: Fixed value: the shape of an official geography code.
GEOGRAPHY_CODE = "[ENSW][0-9]{8}"
#: Rule codes by dataset, with what breaks them.
RULES: dict[str, tuple[Rule, ...]] = {
    "PPD": (
        Rule("MISSING_TRANSACTION_ID", "transaction_id IS NULL"),
        Rule("INVALID_TRANSFER_DATE", "transfer_date IS NULL"),
        Rule("INVALID_PRICE_PAID", "price_paid IS NULL OR price_paid <= 0"),
    ),
    "EPC_CERTIFICATE": (
        Rule("MISSING_CERTIFICATE_NUMBER", "certificate_number IS NULL"),
        Rule("MISSING_INSPECTION_DATE", "inspection_text IS NULL"),
        Rule("INVALID_INSPECTION_DATE", "inspection_text IS NOT NULL AND inspection_date IS NULL"),
        Rule("MISSING_LODGEMENT_DATE", "lodgement_text IS NULL"),
        Rule("INVALID_LODGEMENT_DATE", "lodgement_text IS NOT NULL AND lodgement_date IS NULL"),
        Rule("INVALID_CURRENT_ENERGY_RATING", "current_rating IS NULL OR current_rating NOT IN ('A', 'B', 'C', 'D', 'E', 'F', 'G')"),
        Rule("INVALID_CURRENT_ENERGY_EFFICIENCY", "current_efficiency IS NULL OR current_efficiency <= 0"),
    ),
    "EPC_RECOMMENDATION": (
        Rule("MISSING_CERTIFICATE_NUMBER", "certificate_number IS NULL"),
        Rule("INVALID_IMPROVEMENT_ITEM", "improvement_item IS NULL OR improvement_item <= 0"),
    ),
    "ONSUD": (Rule("INVALID_UPRN", "uprn IS NULL OR uprn = 0"),),
}


def shown(name: str) -> Column:
    return blank_to_null(F.col(f"{name}_raw"))


def _upper(name: str) -> Column:
    return F.upper(shown(name))


def _day(name: str, pattern: str = "y-M-d") -> Column:
    return F.try_to_timestamp(trimmed(F.col(f"{name}_raw")), F.lit(pattern)).cast("date")


#: Per dataset the typed values that its rules look at.
_TYPED = {
    "PPD": lambda: {"transaction_id": shown("transaction_id"), "transfer_date": _day("transfer_date", "y-M-d H:m"), "price_paid": trimmed(F.col("price_paid_raw")).try_cast("decimal(18,2)")},
    "EPC_CERTIFICATE": lambda: {
        "certificate_number": shown("certificate_number"), "inspection_text": shown("inspection_date"), "inspection_date": _day("inspection_date"), "lodgement_text": shown("lodgement_date"),
        "lodgement_date": _day("lodgement_date"), "current_rating": _upper("current_energy_rating"),
        "current_efficiency": F.round(trimmed(F.col("current_energy_efficiency_raw")).try_cast("decimal(38,10)"), 0).try_cast("smallint"),
    },
    "EPC_RECOMMENDATION": lambda: {"certificate_number": shown("certificate_number"), "improvement_item": strict_integer(F.col("improvement_item_raw"), "int", signed=False)},
    "ONSUD": lambda: {"uprn": strict_unsigned(F.col("uprn_raw"))},
}


def typed(raw: DataFrame, dataset: str) -> DataFrame:
    """raw with the values that its dataset's fatal rules look at."""
    return raw.withColumns(_TYPED[dataset]())


def quarantined(raw: DataFrame, dataset: str, raw_columns: Sequence[str]) -> DataFrame:
    """An event for each fatal rule that a row breaks, with the raw values as JSON."""
    events = quarantine(typed(raw, dataset), F.col("source_record_key"), RULES[dataset], raw_columns)
    return events.select(F.lit(dataset).alias("source_dataset"), "record_key", "rule_code", "raw_record", F.lit("NOT_REPLAYED").alias("replay_status"), "quarantine_key")


def sales(raw: DataFrame) -> DataFrame:
    """Accepted sales: typed price and day, postcode, comparison address, category flags."""
    parts = ("paon", "saon", "street", "locality", "town_city", "district", "county")
    category = _upper("category")
    values = {p: shown(p) for p in parts} | {
        "postcode": postcode(F.col("postcode_raw")),
        "postcode_parse_status": postcode_status(F.col("postcode_raw")),
        "address_comparison": normalise_address(F.concat_ws(" ", *(shown(p) for p in parts))),
        "property_type": _upper("property_type"),
        "old_new": _upper("old_new"),
        "duration": _upper("duration"),
        "ppd_category": category,
        "is_additional_ppd_transaction": F.when(category == "B", True).when(category == "A", False),
        "category_status": F.when(category.isNull(), "MISSING").when(category.isin("A", "B"), "VALID").otherwise("UNKNOWN"),
        "record_status": _upper("record_status"),
    }
    out = accepted(typed(raw, "PPD"), RULES["PPD"]).withColumns(values)
    return out.select("source_record_key", "transaction_id", "transfer_date", "price_paid", *values)


_DETAILS = ("address1", "address2", "address3", "posttown", "tenure", "property_type")


def certificates(raw: DataFrame, payload: Sequence[str]) -> DataFrame:
    """Accepted certificates with their statuses and the conflict class of their number over the payload columns.

    A number's class needs its row count and the extremes of its payload's key, which one aggregation combines before
    its only shuffle; the class then joins its rows.
    """
    good = accepted(typed(raw, "EPC_CERTIFICATE"), RULES["EPC_CERTIFICATE"]).withColumn("payload_key", stable_sha256("certificate-payload", "v1", *payload))
    classes = conflict_classes(good, ["certificate_number"], F.col("payload_key")).withColumnRenamed("row_count", "certificate_observation_count")
    number, tenure, score = strict_unsigned(F.col("uprn_raw")), shown("tenure"), F.col("current_efficiency")
    values = {
        **{c: shown(c) for c in _DETAILS},
        "postcode": postcode(F.col("postcode_raw")),
        "postcode_parse_status": postcode_status(F.col("postcode_raw")),
        "uprn": F.when(number > 0, number),
        "uprn_parse_status": F.when(shown("uprn").isNull(), "MISSING").when(F.coalesce(number, F.lit(0)) == 0, "INVALID").otherwise("VALID"),
        "address_comparison": normalise_address(F.concat_ws(" ", shown("address1"), shown("address2"), shown("address3"))),
        "current_efficiency_range_status": F.when(score > 100, "ABOVE_STANDARD_RANGE").otherwise("STANDARD_RANGE"),
        "current_band_score_status": F.when(F.col("current_rating") == band(score), "CONSISTENT").otherwise("INCONSISTENT"),
        "chronology_status": F.when(F.col("inspection_date") > F.col("lodgement_date"), "INSPECTION_AFTER_LODGEMENT").otherwise("VALID"),
        "tenure_observation_status": F.when(tenure.isNull(), "MISSING").when(F.lower(tenure) == "unknown", "SOURCE_UNKNOWN").otherwise("OBSERVED"),
    }
    kept = ["source_record_key", "certificate_number", "inspection_date", "lodgement_date", "current_rating", "current_efficiency"]
    return good.withColumns(values).select(*kept, *values).join(classes, "certificate_number")


def sale_facts(staged: DataFrame) -> DataFrame:
    """Sales under their key (transaction, publisher's status), with the status in words."""
    status = F.when(F.col("record_status") == "A", "ACTIVE").when(F.col("record_status") == "C", "CORRECTED").when(F.col("record_status") == "D", "DELETED").otherwise("UNKNOWN")
    key = stable_sha256("sale-transaction", "v1", "transaction_id", "record_status")
    return staged.select(key.alias("sale_transaction_key"), *(F.col(c).alias("publisher_record_status" if c == "record_status" else c) for c in staged.columns), status.alias("record_status"), F.lit("GBP").alias("currency_code"))


def reference_codes(raw: DataFrame, kind: str, code: str, name: str, release_key: str, flag: str | None = None, welsh: str | None = None) -> DataFrame:
    """Rows of a name-and-code list with their parse status; code and name show only where that is VALID.

    flag: a Y or N column that says whether two kinds of area share a boundary. welsh: a column of names in Welsh.
    """
    observed, called = _upper(code), shown(name)
    status = F.when(observed.isNull(), "MISSING_CODE").when(~full_match(observed, GEOGRAPHY_CODE), "INVALID_CODE").when(called.isNull(), "MISSING_NAME").otherwise("VALID")
    number = strict_unsigned(F.col("objectid_raw"))
    number_status = F.when(shown("objectid").isNull(), "MISSING").when(number.isNull(), "INVALID").otherwise("VALID")
    columns = [
        stable_sha256("reference-observation", "v1", F.lit(release_key), F.lit(kind), "source_record_key").alias("geography_reference_observation_key"),
        "source_record_key",
        F.lit(kind).alias("geography_type"),
        observed.alias("geography_code_observation"),
        F.when(status == "VALID", observed).alias("geography_code"),
        called.alias("geography_name_observation"),
        F.when(status == "VALID", called).alias("geography_name"),
        status.alias("geography_parse_status"),
        number.alias("object_id_observation"),
        number_status.alias("object_id_parse_status"),
        F.lit(release_key).alias("release_key"),
    ]
    if welsh:
        columns.append(shown(welsh).alias("geography_name_welsh_observation"))
    if flag:
        said = _upper(flag)
        columns += [
            said.alias("co_terminous_observation"),
            F.when(said.isin("Y", "N"), said == "Y").alias("is_co_terminous"),
            F.when(said.isNull(), "MISSING").when(said.isin("Y", "N"), "VALID").otherwise("INVALID").alias("co_terminous_parse_status"),
        ]
    return raw.select(*columns)


_ALLOCATED = ("uprn", "postcode", "easting", "northing", "lsoa_code", "msoa_code", "lad_code")


def allocation_rows(raw: DataFrame, release_key: str) -> DataFrame:
    """Accepted allocation rows with the key of what they say."""
    out = accepted(typed(raw, "ONSUD"), RULES["ONSUD"]).withColumns(
        {
            "postcode": postcode(F.col("pcds_raw")),
            "easting": strict_integer(F.col("gridgb1e_raw")),
            "northing": strict_integer(F.col("gridgb1n_raw")),
            "lsoa_code": shown("lsoa21cd"),
            "msoa_code": shown("msoa21cd"),
            "lad_code": shown("lad25cd"),
        }
    )
    return out.select("source_record_key", *_ALLOCATED, stable_sha256("uprn-allocation", "v1", F.lit(release_key), *_ALLOCATED).alias("allocation_key"))


def allocations(rows: DataFrame) -> DataFrame:
    """Distinct allocations, and whether their number has one, one given several times, or several that differ."""
    each = rows.groupBy("allocation_key", *_ALLOCATED).agg(F.count("*").alias("source_row_count"))
    per = each.groupBy("uprn").agg(F.count("*").alias("__kinds"))
    status = F.when(F.col("__kinds") > 1, "CONFLICT").when(F.col("source_row_count") > 1, "EXACT_DUPLICATE").otherwise("UNIQUE")
    return each.join(per, "uprn").withColumn("allocation_status", status).select("allocation_key", *_ALLOCATED, "source_row_count", "allocation_status")


def allocation_bridge(rows: DataFrame, staged: DataFrame) -> DataFrame:
    """Each accepted raw row with the allocation that it supports, joined on the key computed anew."""
    return rows.select("source_record_key", "allocation_key", "uprn").join(staged.select("allocation_key", "allocation_status"), "allocation_key")


def bridged(rows: DataFrame) -> DataFrame:
    """`allocation_bridge` of rows with `allocations` of the same rows: a status follows from the number alone, of whose rows two
    64-bit hashes tell whether they say the same, so rows are neither counted nor joined by their keys."""
    says = {f"__h{k}": F.xxhash64(F.lit(k), *_ALLOCATED, *(F.col(c).isNull() for c in _ALLOCATED)) for k in (1, 2)}
    per = rows.filter("uprn IS NOT NULL").select("uprn", *(h.alias(c) for c, h in says.items())).groupBy("uprn")
    per = per.agg(F.count("*").alias("__n"), *(f(c).alias(f"{c}_{f.__name__}") for c in says for f in (F.min, F.max)))
    differ = (F.col("__h1_min") != F.col("__h1_max")) | (F.col("__h2_min") != F.col("__h2_max"))
    status = F.when(differ, "CONFLICT").when(F.col("__n") > 1, "EXACT_DUPLICATE").otherwise("UNIQUE")
    return rows.select("allocation_key", "source_record_key", "uprn").join(per.select("uprn", status.alias("allocation_status")), "uprn").select("allocation_key", "source_record_key", "uprn", "allocation_status")


def required_numbers(certificates: DataFrame, release_key: str) -> DataFrame:
    """Distinct valid property numbers that certificates refer to, for a selected release."""
    found = certificates.filter("uprn IS NOT NULL").groupBy("uprn").agg(
        F.count("*").alias("source_reference_count"), F.countDistinct("certificate_number").alias("distinct_certificate_count"),
        F.min("inspection_date").alias("first_observed_date"), F.max("inspection_date").alias("last_observed_date"),
    )
    key = stable_sha256("required-uprn", "v1", F.lit(release_key), "uprn", F.lit("CERTIFICATES_V1"))
    return found.select(key.alias("required_uprn_key"), F.lit(release_key).alias("release_key"), "*")


def property_class(source: Column, property_type: Column) -> Column:
    """HOUSE, FLAT or OTHER of a sale's letter or a certificate's words."""
    letter = F.when(property_type.isin("D", "S", "T"), "HOUSE").when(property_type == "F", "FLAT").otherwise("OTHER")
    words = F.lower(property_type)
    return F.when(source == "PPD", letter).otherwise(F.when(_any(words, ("flat", "maisonette")), "FLAT").when(_any(words, ("house", "bungalow", "park home")), "HOUSE").otherwise("OTHER"))


def _any(text: Column, words: Sequence[str]) -> Column:
    out = F.lit(False)
    for w in words:
        out = out | text.like(f"%{w}%")
    return F.coalesce(out, F.lit(False))


def parse_route(certificates: DataFrame, selector: str, contract: str) -> DataFrame:
    """Certificates whose address needs the parser: two numbers or more, and a unit named or a flat by its type."""
    address = F.concat_ws(" ", "address1", "address2", "address3")
    upper = F.upper(address)
    numbers = F.size(F.regexp_extract_all(upper, F.lit("([0-9]+[A-Z]?)"), F.lit(1)))
    unit = upper.rlike(rf"(^|[^A-Z0-9])({'|'.join(UNITS)}) *[0-9]+[A-Z]?")
    flat = _any(F.lower(F.col("property_type")), ("flat", "maisonette"))
    known = certificates.filter("postcode_parse_status = 'VALID'").select(
        "source_record_key", F.concat_ws(", ", "address1", "address2", "address3", "posttown", "postcode", F.lit("United Kingdom")).alias("parser_input"),
        numbers.alias("numeric_designator_count"), unit.alias("has_explicit_unit_designator"), flat.alias("has_flat_property_type"),
    )
    routed = known.filter("numeric_designator_count >= 2 AND (has_explicit_unit_designator OR has_flat_property_type)")
    reason = F.when(F.col("has_explicit_unit_designator"), "EXPLICIT_UNIT_MULTI_NUMBER").otherwise("FLAT_PROPERTY_MULTI_NUMBER")
    routed = routed.withColumns({"selection_reason": reason, "parser_input_key": stable_sha256("address-parser-input", "v1", F.lit(contract), "parser_input")})
    key = stable_sha256("address-parser-route", "v1", F.lit(selector), "source_record_key", "parser_input_key", "selection_reason")
    return routed.withColumn("route_selection_key", key)


def route_manifest(route: DataFrame, selector: str, contract: str) -> DataFrame:
    """One row: routed rows, distinct inputs, and a fingerprint of the population.

    The reference order of the keys is kept by hashing them in 4096 sorted parts by prefix, so that no text holds all.
    """
    part = route.groupBy(F.substring("route_selection_key", 1, 3).alias("part")).agg(
        F.count("*").alias("n"), F.sha2(F.array_join(F.sort_array(F.collect_list("route_selection_key")), ""), 256).alias("digest")
    )
    whole = part.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("n"), F.sha2(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("part", "digest"))), lambda x: x["digest"]), ""), 256).alias("digest"))
    inputs = route.agg(F.countDistinct("parser_input_key").alias("inputs"))
    key = stable_sha256("address-parser-route-population", "v1", F.lit(selector), F.lit(contract), "n", "digest")
    return whole.crossJoin(inputs).select(
        F.lit(selector).alias("selector_contract_version"), F.lit(contract).alias("parser_input_contract_version"), F.col("n").alias("routed_observation_count"), F.col("inputs").alias("distinct_parser_input_count"), key.alias("route_population_fingerprint")
    )
