"""Line dedup: an exact set-similarity join of lines, in DataFrame operations only.

A line is a \\n-split part of a text with at least one word; its tokens are its distinct words, by their 64-bit hashes.
Lines are ordered by (doc_id, hash of the whole text, line number); a null doc_id comes first. A line is removed if an
earlier one has a token set with Jaccard similarity THRESHOLD or more, itself removed or not. Parts without a word stay;
null text stays null. Rows alike in doc_id and text count as one document and keep the same lines. Any other column is
passed through, whatever its name. An empty table gives an empty one.

Texts are split once, into a table of token sets. Equal lines are met by one aggregation. Between different ones the join
is a prefix filter: tokens are ordered by rarity (lines with their hash bucket, of a table of fixed size), lines that are
similar enough share a token among their first n - ceil(t n) + 1, and a pair goes on only if sizes, the places of the
shared token and the parity bitmaps of both sets (whose differing bits never exceed the differing tokens) allow the
similarity. A line needs one match: it first meets an early line of each of its PROBES rarest tokens, which settles
nearly all of a group of near copies without pairing its members. The pairs of the lines left are kept, each once. The likeliest
(fewest differing bits) is verified on the token sets first, and only lines which that leaves have their other pairs
verified. Lists above LIST lines first meet their earliest line alone; only their lines left meet the rest, dealt by
classes of size, of which a line can match three or four at most, unless they are few enough to be broadcast.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from evidentia.llm.common import SPACES, drop_tables, scratch_table, spread

#: Similarity as a fraction.
THRESHOLD = (4, 5)
#: Buckets of the rarity table.
BUCKETS = 1 << 17
#: Tokens by which a line first meets an earliest one.
PROBES = 4
#: Lists up to this length pair their lines at once.
LIST = 1024
#: A side of a join is broadcast up to so many rows of a few longs, counted before.
BROADCAST_ROWS = 1_000_000
#: Prefix tokens that one task of the join should sort.
POSTED = 1 << 19
#: A line's place is 33 bits of its text's hash and its number, which no text exceeds.
_LINE_BITS = 31
_LEAST = -(1 << 63)
#: Larger dictionaries than usual, as the same tokens come again and again.
_TOKENS_AS = {"parquet.dictionary.page.size": str(16 << 20), "parquet.block.size": str(32 << 20)}


def _doc_key(unique: bool) -> list[Column]:
    """What orders the documents: the id, and 33 bits of the text's hash, 0 where ids are unique, as it orders nothing then."""
    text_hash = F.lit(0).cast("long") if unique else F.shiftrightunsigned(F.xxhash64(F.col("text").cast("string")), _LINE_BITS)
    return [F.coalesce(F.col("doc_id").cast("long"), F.lit(_LEAST)).alias("d"), text_hash.alias("h")]


def _unique_ids(docs: DataFrame) -> bool:
    one = docs.select(*_doc_key(True)).agg(F.count("*").alias("n"), F.countDistinct("d").alias("ids")).first()
    return one.n == one.ids


def _token_sets(docs: DataFrame, unique: bool) -> DataFrame:
    """d and s place a line, k1 and k2 are 95 bits of its text's hash, t has its n tokens; n is 0 for lines without a word."""
    split = docs.select(*_doc_key(unique), F.posexplode(F.split(F.col("text").cast("string"), "\n", -1)).alias("line_no", "line"))
    place = F.shiftleft("h", _LINE_BITS).bitwiseOR(F.col("line_no").cast("long"))
    rare, spaced, line = F.lit(False), F.col("line"), F.col("line")
    for mark in SPACES:
        if mark not in " \n":
            rare, spaced = rare | F.contains(line, F.lit(mark)), F.replace(spaced, F.lit(mark), F.lit(" "))
    words = F.transform(F.split(F.when(rare, spaced).otherwise(line), " "), lambda w: F.xxhash64(w))
    tokens = split.select("d", place.alias("s"), F.xxhash64("line").alias("k1"), F.xxhash64(F.lit(1), "line").bitwiseAND((1 << 31) - 1).cast("int").alias("k2"), F.array_distinct(F.array_remove(words, F.xxhash64(F.lit("")))).alias("t"))
    return tokens.withColumn("n", F.size("t"))


def _bucket(token: Column) -> Column:
    return token.bitwiseAND(BUCKETS - 1).cast("int")


def _rarity(sets: DataFrame) -> Column:
    """An array with a level from 1 to 127 for every token bucket, by the logarithm of the lines that have it."""
    spark = sets.sparkSession
    uses = sets.select(F.explode("t").alias("t")).groupBy(_bucket(F.col("t")).alias("b")).agg(F.count("*").alias("n"))
    level = F.coalesce(F.least(F.lit(127), F.lit(1) + F.floor(4 * F.log2("n"))).cast("int"), F.lit(1)).alias("level")
    every = spark.range(BUCKETS).select(F.col("id").cast("int").alias("b")).join(uses, "b", "left").select("b", level)
    levels = every.agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("b", "level"))), lambda x: x["level"].cast("string")), ",")).first()[0]
    return F.split(F.lit(levels), ",").cast("array<tinyint>")


def _keyed(sets: DataFrame, levels: Column) -> DataFrame:
    """d, s, the line's token number n, its parity bitmap of 128 bits (b0, b1) and its prefix of tokens by rarity."""
    num, den = THRESHOLD
    key = lambda t: F.shiftleft(levels[t.bitwiseAND(BUCKETS - 1)].cast("long"), 56).bitwiseOR(F.shiftrightunsigned(t, 8))
    parity = lambda some: F.aggregate(some, F.lit(0).cast("long"), lambda a, t: a.bitwiseXOR(F.call_function("shiftleft", F.lit(1).cast("long"), t.bitwiseAND(63).cast("int"))))
    b0, b1 = parity(F.filter("t", lambda t: t < 0)), parity(F.filter("t", lambda t: t >= 0))
    ordered = sets.select("d", "s", "n", b0.alias("b0"), b1.alias("b1"), F.sort_array(F.transform("t", key)).alias("t"))
    return ordered.select("d", "s", "n", "b0", "b1", F.slice("t", 1, F.expr(f"cast(n - (n * {num}L + {den - 1}) DIV {den} + 1 AS int)")).alias("prefix"))


def _posted(keys: DataFrame) -> DataFrame:
    """A row for each token of a prefix; np is the line's token number above a bit for open lines and 31 bits of the token's place."""
    rest = [c for c in keys.columns if c not in ("n", "prefix", "open")]
    open_ = F.shiftleft(F.col("open").cast("long"), 31) if "open" in keys.columns else F.lit(0).cast("long")
    entries = keys.select(*rest, "n", open_.alias("open"), F.posexplode("prefix").alias("p", "token"))
    return entries.select(*rest, F.shiftleft(F.col("n").cast("long"), 32).bitwiseOR(F.col("open")).bitwiseOR(F.col("p").cast("long")).alias("np"), "token")


_SIZE, _PLACE = "shiftright({0}.np, 32)", "({0}.np & 2147483647L)"
_DIFFER = "bit_count(x.b0 ^ y.b0) + bit_count(x.b1 ^ y.b1)"
_PAIR = ["x.d AS xd", "x.s AS xs", "y.d AS yd", "y.s AS ys", f"cast({_DIFFER} AS int) AS e"]


def _may_match() -> Column:
    """Later line x and earlier line y that share a token at their places: sizes, places and bitmaps allow the similarity."""
    num, den = THRESHOLD
    (xn, yn), (xp, yp) = ([part.format(side) for side in "xy"] for part in (_SIZE, _PLACE))
    differ = f"({xn} + {yn} - 2 * ((({xn} + {yn}) * {num} + {num + den - 1}) DIV {num + den}))"
    return F.expr(f"(x.d > y.d OR (x.d = y.d AND x.s > y.s)) AND {xn} * {den} >= {yn} * {num} AND {yn} * {den} >= {xn} * {num} AND {xp} + {yp} <= {differ} AND {_DIFFER} <= {differ}")


def _paired(x: DataFrame, y: DataFrame, on: tuple[str, ...] = ("token",)) -> DataFrame:
    """Pairs of entries that share a token and may match, of lines x that are open. That condition names both sides (y's is
    never below 0), or it would make two exchanges of a table that is joined with itself."""
    same = F.expr("(x.np & 2147483648L) > least(y.np, 0L)")
    for c in on:
        same &= F.col(f"x.{c}") == F.col(f"y.{c}")
    return x.alias("x").join(y.alias("y"), same & _may_match()).selectExpr(*_PAIR)


def _if_few(rows: DataFrame, n: int) -> DataFrame:
    return F.broadcast(rows) if n <= BROADCAST_ROWS else rows


def _hot_lists(posted: DataFrame) -> DataFrame:
    """Tokens of lists above LIST, counted exactly where their bucket is above it."""
    full = posted.groupBy(_bucket(F.col("token")).alias("b")).agg(F.count("*").alias("n")).filter(F.col("n") > LIST).select("b")
    full = scratch_table(full, "full-buckets")  # BUCKETS rows at most
    near = posted.withColumn("b", _bucket(F.col("token"))).join(F.broadcast(full), "b", "left_semi")
    return near.groupBy("token").agg(F.count("*").alias("n")).filter(F.col("n") > LIST).select("token")


def _similar(sets: DataFrame, pairs: DataFrame) -> DataFrame:
    """Distinct later lines (d, s) of the pairs that are similar by their token sets."""
    num, den = THRESHOLD
    wanted = pairs.select(F.col("xd").alias("d"), F.col("xs").alias("s")).unionByName(pairs.select(F.col("yd").alias("d"), F.col("ys").alias("s"))).distinct()
    wanted = scratch_table(wanted, "wanted-lines")
    found = sets.select("d", "s", "t").join(_if_few(wanted, wanted.count()), ["d", "s"])
    found = scratch_table(found.groupBy("d", "s").agg(F.first("t").alias("t")), "wanted-sets")
    x, y = (found.select(*(F.col(c).alias(f"{side}{c}") for c in ("d", "s", "t"))) for side in "xy")
    both = pairs.join(x, ["xd", "xs"]).join(y, ["yd", "ys"]).withColumn("o", F.size(F.array_intersect("xt", "yt")))
    similar = both.filter(F.expr(f"o * {den}L >= (size(xt) + size(yt) - o) * {num}L"))
    return similar.select(F.col("xd").alias("d"), F.col("xs").alias("s")).distinct()


def _classed(x: DataFrame, y: DataFrame, hot: DataFrame, n_hot: int) -> tuple[DataFrame, DataFrame]:
    """Entries of later lines x and of their tokens' lists in y, dealt by `part`: for hot tokens a class of size.

    A line stands in its own class; an earlier one in those of all sizes that it can match, three or four.
    """
    tokens = scratch_table(x.select("token").distinct(), "tokens-left")
    sought = y.join(_if_few(tokens, tokens.count()), "token", "left_semi")
    marked = _if_few(hot.withColumn("hot", F.lit(True)), n_hot)
    size = lambda n: f"ln({n}) / ln(1.25D)"
    dealt = lambda rows, classes: rows.join(marked, "token", "left").withColumn("part", F.explode(F.when(F.col("hot"), F.expr(classes)).otherwise(F.array(F.lit(0).cast("long")))))
    return dealt(x, f"array(floor({size('shiftright(np, 32)')}))"), dealt(sought, f"sequence(floor({size('shiftright(np, 32) * 0.8D')} - 1e-9D), floor({size('shiftright(np, 32) * 1.25D')} + 1e-9D))")


def _led_lines(sets: DataFrame, keys: DataFrame) -> DataFrame:
    """(d, s) of the lines that resemble a line of the earliest document of one of their rarest tokens: a pair for each entry at most."""
    probes = _posted(keys.withColumn("prefix", F.slice("prefix", 1, PROBES)))
    first = [F.min("d").alias("d"), *(F.min_by(c, "d").alias(c) for c in ("s", "np", "b0", "b1"))]
    leaders = scratch_table(probes.groupBy("token").agg(*first, F.count("*").alias("n")).filter("n > 1").drop("n"), "probe-leaders")
    y = _if_few(leaders, leaders.count())
    pairs = probes.alias("x").join(y.alias("y"), (F.col("x.token") == F.col("y.token")) & _may_match()).selectExpr(*_PAIR)
    best = pairs.groupBy("xd", "xs").agg(F.min_by("yd", "e").alias("yd"), F.min_by("ys", "e").alias("ys"))
    best = scratch_table(best, "led-pairs", large=True)
    return scratch_table(_similar(sets, best), "led-lines")


def _late_lines(sets: DataFrame, keys: DataFrame) -> DataFrame:
    """(d, s) of the lines that resemble an earlier, different one."""
    spark = sets.sparkSession
    led = _led_lines(sets, keys)
    n_led = led.count()
    keys = keys.join(_if_few(led.withColumn("open", F.lit(0)), n_led), ["d", "s"], "left").withColumn("open", F.coalesce("open", F.lit(1)))
    if n_led > BROADCAST_ROWS:
        keys = scratch_table(keys, "open-keys", large=True)
    posted = _posted(keys)
    hot = scratch_table(_hot_lists(posted), "hot-lists")
    n_hot = hot.count()
    num, den = THRESHOLD
    entries = keys.agg(F.expr(f"sum(n - (n * {num}L + {den - 1}) DIV {den} + 1)")).first()[0] or 0
    parts = spread(spark, entries, POSTED)
    marked = _if_few(hot, n_hot)
    dealt = (posted.join(marked, "token", "left_anti") if n_hot else posted).repartition(parts, "token")
    pairs = _paired(dealt, dealt)
    if n_hot:
        long_ = scratch_table(posted.join(_if_few(hot, n_hot), "token"), "hot-entries")
        leaders = long_.groupBy("token").agg(F.min(F.struct("d", "s", "np", "b0", "b1")).alias("y")).select("token", "y.*")
        pairs = pairs.unionByName(_paired(long_, _if_few(leaders, n_hot)))
    pairs = scratch_table(pairs.groupBy("xd", "xs", "yd", "ys").agg(F.min("e").alias("e")), "candidate-pairs", large=True)
    best = pairs.groupBy("xd", "xs").agg(F.min_by("yd", "e").alias("yd"), F.min_by("ys", "e").alias("ys"), F.count("*").alias("n"))
    best = scratch_table(best, "likely-pairs")
    sure = scratch_table(led.unionByName(_similar(sets, best.select("xd", "xs", "yd", "ys"))), "likely-lines")
    n_sure = sure.count()
    left = best.filter("n > 1").join(_if_few(sure, n_sure), F.expr("xd = d AND xs = s"), "left_anti")
    left = scratch_table(left.select("xd", "xs", F.col("yd").alias("bd"), F.col("ys").alias("bs")), "lines-left")
    others = pairs.drop("e").join(_if_few(left, left.count()), ["xd", "xs"]).filter("yd <> bd OR ys <> bs").drop("bd", "bs")
    if n_hot:
        open_ = scratch_table(long_.join(_if_few(sure, n_sure), ["d", "s"], "left_anti"), "entries-left")
        if open_.count() <= BROADCAST_ROWS:
            met = _paired(F.broadcast(open_), long_)
        else:
            met = _paired(*_classed(open_, long_, hot, n_hot), ("token", "part"))
        met = met.drop("e").distinct().join(pairs.select("xd", "xs", "yd", "ys"), ["xd", "xs", "yd", "ys"], "left_anti")
        others = others.unionByName(met)
    others = scratch_table(others, "other-pairs", large=bool(n_hot))
    return sure.unionByName(_similar(sets, others))


def removed_lines(docs: DataFrame, unique: bool = False) -> tuple[DataFrame, list[DataFrame]]:
    """(d, s) of every line to remove, and the scratch tables that this is read from. unique: no doc_id comes twice."""
    table = scratch_table(_token_sets(docs, unique), "token-sets", options=_TOKENS_AS)
    sets = table.filter("n > 0")
    again = sets.groupBy("k1", "k2").agg(F.min(F.struct("d", "s")).alias("first"), F.count("*").alias("n")).filter("n > 1")
    again = scratch_table(again.select("k1", "k2", F.col("first.d").alias("fd"), F.col("first.s").alias("fs")), "repeated-lines")
    met = sets.join(_if_few(again, again.count()), ["k1", "k2"], "left")
    is_first = F.col("fd").isNull() | ((F.col("d") == F.col("fd")) & (F.col("s") == F.col("fs")))
    keys = scratch_table(_keyed(met.filter(is_first), _rarity(sets)), "line-keys")
    late = _late_lines(sets, keys)
    return met.filter(~is_first).select("d", "s").unionByName(late), [table, keys]


def dedup_lines(docs: DataFrame) -> DataFrame:
    """docs with its text rid of removed lines, and `__n_lines` and `__n_removed` (lines with a word, and those removed).

    These two take the place of columns of their names.
    """
    unique = _unique_ids(docs)
    removed, tables = removed_lines(docs, unique)
    gone = removed.select("d", F.shiftrightunsigned("s", _LINE_BITS).alias("h"), F.col("s").bitwiseAND((1 << _LINE_BITS) - 1).cast("int").alias("line_no"))
    gone = scratch_table(gone.groupBy("d", "h").agg(F.collect_set("line_no").alias("gone")), "removed-lines", large=True)
    drop_tables(*tables)
    few = gone.agg(F.count("*"), F.sum(F.size("gone"))).first()
    names = [c for c in docs.columns if c not in ("__n_lines", "__n_removed")]
    rest = [F.col(f"`{c}`") for c in names if c != "text"]
    d, h = _doc_key(unique)
    mine = docs.select(F.struct(*(rest or [F.lit(0).alias("none")])).alias("__row"), d.alias("__d"), h.alias("__h"), F.col("text").cast("string").alias("__text"))
    gone = gone.select(F.col("d").alias("__d"), F.col("h").alias("__h"), "gone")
    if few[0] <= BROADCAST_ROWS and (few[1] or 0) <= 10 * BROADCAST_ROWS:
        gone = F.broadcast(gone)
    joined = mine.join(gone, ["__d", "__h"], "left").withColumn("__parts", F.split("__text", "\n", -1))
    left = F.expr("transform(array_except(sequence(0, size(__parts) - 1), gone), i -> __parts[i])")
    joined = joined.withColumn("__new", F.when(F.col("gone").isNull(), F.col("__text")).otherwise(F.array_join(left, "\n")))
    with_word = F.size(F.filter("__parts", lambda x: F.btrim(x, F.lit(SPACES)) != ""))
    kept = [F.col("__new").alias("text") if c == "text" else F.col("__row").getField(c).alias(c) for c in names]
    return joined.select(*kept, F.coalesce(with_word, F.lit(0)).cast("long").alias("__n_lines"), F.coalesce(F.size("gone"), F.lit(0)).cast("long").alias("__n_removed"))
