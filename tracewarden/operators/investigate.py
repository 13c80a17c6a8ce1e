"""Investigation datasets for all users at once; one user is ``where(user_id = ...)``.

Lists that may grow without bound (a user's detections, report lines) stay in long form, one
row per item with an order key. Only lists bounded by a limit are nested.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.text import as_flag, strip
from .dedupe import first_per_key
from .quality import two_decimals

ROUTINE = "Routine activity monitoring."
NO_FINDING = "No critical security anomalies detected."
LARGE_TRANSFER_BYTES = 10_000_000


def _or(name: str, default: str) -> Column:
    return F.coalesce(F.col(name), F.lit(default))


def _text(name: str) -> Column:
    return F.coalesce(F.col(name).cast("string"), F.lit(""))


def one_decimal(c: Column) -> Column:
    return F.rint(c * 10) / 10


# --- users ------------------------------------------------------------------------------

def known_users(identity: DataFrame, risk: DataFrame) -> DataFrame:
    ids = identity.select("user_id").union(risk.select("user_id"))
    return ids.select(F.upper(strip(F.col("user_id"))).alias("user_id")).dropna().distinct()


def existing_users(candidates: DataFrame, identity: DataFrame, risk: DataFrame) -> DataFrame:
    """The candidates (column ``user_id``) that identity or risk knows."""
    wanted = candidates.withColumn("user_id", F.upper(strip(F.col("user_id"))))
    return wanted.join(known_users(identity, risk), "user_id", "left_semi")


# ids of any length: beyond six digits they are as valid in a large directory
_ID = r"(?i)\b(EMP\s*[-_]?\s*\d+|USR\s*[-_]?\s*\d+)\b"
_SHORTEST_NAME = 4


def id_mentions(texts: DataFrame, keys: Sequence[str], known: DataFrame) -> DataFrame:
    """Explicit ids, separators removed (a dashed USR id keeps its spelling)."""
    found = texts.select(
        *keys, F.explode(F.array_distinct(F.regexp_extract_all("text", F.lit(_ID), F.lit(1))))
        .alias("spelled")
    )
    spelled = F.upper(F.col("spelled"))
    user = F.when(spelled.startswith("USR") & spelled.contains("-"), spelled).otherwise(
        F.regexp_replace(spelled, r"[\s\-_]", ""))
    lookup = known.withColumn("known", F.lit(True))
    return (
        found.withColumn("user_id", user).join(lookup, "user_id", "left")
        .select(*keys, "user_id", as_flag(F.col("known")).alias("found"), F.lit("id").alias("how"))
    )


def directory_names(identity: DataFrame) -> DataFrame:
    """(name, user_id): full names and usernames of at least four characters, lower case."""
    user = F.upper(strip(F.col("user_id"))).alias("user_id")
    names = identity.select(user, F.explode(F.array("full_name", "username")).alias("name"))
    name = F.lower(strip(F.col("name")))
    return (
        names.select("user_id", name.alias("name")).where("user_id IS NOT NULL")
        .where(F.length("name") >= _SHORTEST_NAME).distinct()
    )


# bits of the filter of name beginnings: a fixed size, whatever the directory's
FILTER_BITS = 1 << 20


def _beginning(word: Column, count: Column) -> Column:
    """Place of a first word and a number of words in the filter."""
    return F.pmod(F.xxhash64(word, count), F.lit(FILTER_BITS))


def beginnings_filter(names: DataFrame) -> list[int]:
    """Words of 64 bits, FILTER_BITS in all, with the beginnings of the names set (``words``, ``first``)."""
    at = _beginning(F.col("first"), F.col("words"))
    bit = F.expr("shiftleft(1L, cast(at % 64 as int))")
    rows = names.select(at.alias("at")).distinct().select((F.col("at") / 64).cast("int").alias("place"), bit.alias("bit"))
    found = rows.groupBy("place").agg(F.bit_or("bit").alias("bits")).collect()  # at most FILTER_BITS / 64 rows
    words = [0] * (FILTER_BITS // 64)
    for r in found:
        words[r["place"]] = r["bits"]
    return words


# users of one name that one task joins with the texts that mention it
NAME_USERS = 256


def _shared_names(names: DataFrame) -> DataFrame:
    """(name, parts) of the names of more than ``NAME_USERS`` users, at most one for every ``NAME_USERS`` rows."""
    parts = F.ceil(F.col("users") / NAME_USERS).cast("int").alias("parts")
    return names.groupBy("name").agg(F.count(F.lit(1)).alias("users")).where(F.col("users") > NAME_USERS).select("name", parts)


def _shared_mentions(found: DataFrame, keys: Sequence[str], names: DataFrame, shared: DataFrame, taken: DataFrame) -> DataFrame:
    """(keys, user_id) once for every text and user of a name in ``shared`` that it mentions, without those in ``taken``.

    Each such name is dealt into parts by user, each of which meets all of its mentions, so no task forms the rows of all
    users of a name. These rows can be as many as texts times users, and nothing of that size is shuffled: a text
    brings its shared names and the users it has already (of ids and of names of few users, so no more than it has
    words, times ``NAME_USERS``), a user of several names is taken by the first that the text has.
    """
    users = names.join(shared, "name").select("name", "user_id", "parts")
    own = users.groupBy("user_id").agg(F.array_sort(F.collect_set("name")).alias("own"))
    dealt = users.join(own, "user_id").select(
        "name", "user_id", "own", F.pmod(F.xxhash64("user_id"), F.col("parts")).cast("int").alias("part"))
    mentions = found.join(shared.select("name"), "name", "left_semi").withColumn("user_id", F.lit(None).cast("string"))
    known = taken.join(own, "user_id", "left_semi").select(*keys, F.lit(None).cast("string").alias("name"), "user_id")
    texts = mentions.select(*keys, "name", "user_id").unionByName(known).groupBy(*keys).agg(
        F.collect_set("name").alias("all"), F.collect_set("user_id").alias("known"))
    spread = (texts.select("*", F.explode("all").alias("name")).join(shared, "name")
              .withColumn("part", F.explode(F.sequence(F.lit(0), F.col("parts") - 1))).drop("parts"))
    first = (F.size("own") == 1) | (F.get(F.array_intersect("own", "all"), F.lit(0)) == F.col("name"))
    new = (F.size("known") == 0) | ~F.array_contains("known", F.col("user_id"))
    return spread.join(dealt, ["name", "part"]).where(first & new).select(*keys, "user_id")


def named_in(texts: DataFrame, keys: Sequence[str], identity: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Whole-word, case-insensitive mentions of names (keys, name), and the users of the names (name, user_id).

    A text is cut once into words and what stands between them. A fixed-size filter of the names'
    first words and word counts tells where a name may begin; only there are runs of words formed
    and compared with the names by an equi-join. So neither the words nor the runs of all texts are shuffled.
    Names begin and end with a word character.
    """
    every = F.regexp_extract_all("name", F.lit(r"(?U)\w+"), F.lit(0))
    names = directory_names(identity).withColumns({"words": F.size(every), "first": F.get(every, F.lit(0))}).where("words > 0")
    counts = sorted(r["words"] for r in names.select("words").distinct().collect())  # lengths of names, not names
    bits = F.from_json(F.lit(str(beginnings_filter(names))), "array<bigint>")
    tokens = texts.select(*keys, F.regexp_extract_all(F.lower("text"), F.lit(r"(?U)\w+|\W+"), F.lit(0)).alias("_tokens"))
    token, size = F.col("_tokens"), F.size("_tokens")

    def may_begin(place: Column, count: Column) -> Column:
        at = _beginning(F.get(token, place), count)
        word = F.get(bits, (at / 64).cast("int"))
        return (F.getbit(word, (at % 64).cast("int")) == 1) & (place + 2 * count - 1 <= size)

    def runs(place: Column) -> Column:
        lengths = F.filter(F.array(*[F.lit(n) for n in counts]).cast("array<int>"), lambda n: may_begin(place, n))
        return F.transform(lengths, lambda n: F.array_join(F.slice(token, place + 1, 2 * n - 1), ""))

    places = F.when(size > 0, F.sequence(F.lit(0), size - 1)).otherwise(F.array().cast("array<int>"))
    found = tokens.select(*keys, F.explode(F.array_distinct(F.flatten(F.transform(places, runs)))).alias("name"))
    return found, names.select("name", "user_id")


def name_mentions(texts: DataFrame, keys: Sequence[str], identity: DataFrame, others: DataFrame | None = None) -> DataFrame:
    """Users mentioned by name, once for each text; with ``others``, rows of mentions of other kinds, merged with those.

    Names of few users and ``others`` are grouped; users of a name that many share are added to that (see ``_shared_mentions``).
    """
    found, names = named_in(texts, keys, identity)
    shared = _shared_names(names)
    many = not shared.isEmpty()
    single = names.join(shared, "name", "left_anti") if many else names
    rows = found.join(single, "name").select(*keys, "user_id", F.lit(True).alias("found"), F.lit("name").alias("how"))
    rows = rows if others is None else rows.unionByName(others)
    mentions = rows.groupBy(*keys, "user_id").agg(F.max("found").alias("found"), F.min("how").alias("how"))
    if not many:
        return mentions
    # a user of a name is known, so a row of ``mentions`` holds all that a shared name would add to it
    more = _shared_mentions(found, keys, names, shared, mentions.select(*keys, "user_id"))
    return mentions.unionByName(more.withColumns({"found": F.lit(True), "how": F.lit("name")}))


def user_mentions(
    texts: DataFrame, keys: Sequence[str], identity: DataFrame, risk: DataFrame
) -> DataFrame:
    """Users mentioned in each text: one row per (text, user); unknown ids have found = false."""
    return name_mentions(texts, keys, identity, id_mentions(texts, keys, known_users(identity, risk)))


# --- context, score, threats -----------------------------------------------------------

def identity_context(identity: DataFrame) -> DataFrame:
    first = first_per_key(identity.where("user_id IS NOT NULL"), "user_id")
    assets = F.concat_ws(", ", F.nullif("hostname", F.lit("")), F.nullif("device_id", F.lit("")))
    return first.select(
        "user_id",
        F.coalesce("full_name", "username", "user_id").alias("user_name"),
        _or("username", "").alias("username"), _or("department", "Unknown").alias("department"),
        _or("role", "Employee").alias("role"), _or("location", "Unknown").alias("location"),
        _or("status", "Active").alias("employment_status"),
        "hire_date", "termination_date",
        _or("hostname", "").alias("hostname"), _or("device_id", "").alias("device_id"),
        _or("manager_username", "None").alias("manager"),
        as_flag(F.col("device_id_conflict")).alias("device_id_conflict"),
        F.greatest(F.coalesce("device_user_count", F.lit(1)), F.lit(1)).alias("device_user_count"),
        F.coalesce(F.nullif(assets, F.lit("")), F.lit("None")).alias("assigned_assets"),
    )


_BREAKDOWN = {
    "authentication": "authentication_risk", "iam": "iam_risk",
    "endpoint": "endpoint_severity_risk", "threat_behaviour": "threat_behavior_risk",
    "context": "contextual_risk", "cross_signal": "cross_signal_bonus",
}
_METRICS = (
    "iam_events", "iam_failed_auth", "iam_mfa_failures", "iam_high_risk_events",
    "endpoint_alerts", "endpoint_critical_alerts", "endpoint_malware_alerts",
    "endpoint_powershell", "post_termination_iam_events", "post_termination_endpoint_events",
)


def risk_profile(risk: DataFrame) -> DataFrame:
    return risk.select(
        "user_id", _or("username", "").alias("username"), _or("department", "").alias("department"),
        _or("role", "").alias("role"), _or("status", "Active").alias("status"),
        one_decimal(F.coalesce("risk_score", F.lit(0.0))).alias("risk_score"),
        F.initcap(F.coalesce("risk_band", "risk_level", F.lit("Low"))).alias("risk_band"),
        _or("risk_drivers", ROUTINE).alias("risk_drivers"),
        as_flag(F.col("post_termination_activity_flag")).alias("post_termination_flag"),
        F.struct(*[one_decimal(F.coalesce(c, F.lit(0.0))).alias(n) for n, c in _BREAKDOWN.items()])
        .alias("score_breakdown"),
        F.struct(*[F.coalesce(c, F.lit(0)).cast("bigint").alias(c) for c in _METRICS]).alias("metrics"),
    )


def threat_order() -> Column:
    """Place of a detection in the published table's order, as one sortable text."""
    return F.concat_ws("|", "severity", "confidence", "threat_type", "threat_id")


_QUEUE_ENTRY = (
    "priority_rank", "investigation_priority", "investigation_priority_score",
    "threat_detection_count", "distinct_threat_types", "threat_types", "investigation_reason",
)


def user_threats(threats: DataFrame, queue: DataFrame) -> DataFrame:
    """One row per detection of a user, with the user's queue entry (null outside the queue)."""
    entry = queue.select("user_id", F.struct(
        *_QUEUE_ENTRY, "recommended_action").alias("investigation_queue"))
    rows = threats.select(
        "user_id", "threat_id", F.col("threat_type").alias("threat_name"),
        F.upper(_or("severity", "Medium")).alias("severity"),
        _or("confidence", "Medium").alias("confidence"), _or("evidence", "").alias("evidence"),
        "first_observed", "last_observed", _or("related_hostname", "").alias("related_hostname"),
        _or("recommended_action", "").alias("recommended_action"),
        threat_order().alias("threat_order"),
    )
    return rows.join(entry, "user_id", "left")


# --- per-user events ------------------------------------------------------------------------

SALTS = 16


def _first_rows(df: DataFrame, keys: list[str], order: list[Column], n: int, name: str) -> DataFrame:
    """The first n rows per key in one shuffle, which each partition enters with at most n rows of a key."""
    rank = F.row_number().over(Window.partitionBy(*keys).orderBy(*order))
    return df.withColumn(name, rank).where(F.col(name) <= n)


def _earliest(
    df: DataFrame, key: str | list[str], order: list[Column], n: int, name: str = "event_no"
) -> DataFrame:
    """The first n rows per key, in two levels.

    Each level is limited per partition before its shuffle: first by key and a salt of the row, then by
    key. So the task that ranks a busy key sees at most n rows of each salt, however many partitions the rows come from.
    """
    keys = [key] if isinstance(key, str) else key
    salted = df.withColumn("_salt", F.pmod(F.xxhash64(*[F.col(c) for c in df.columns]), F.lit(SALTS)))
    near = F.row_number().over(Window.partitionBy(*keys, "_salt").orderBy(*order))
    few = salted.withColumn("_near", near).where(F.col("_near") <= n).drop("_near", "_salt")
    return _first_rows(few, keys, order, n, name)


# rows of a key that are numbered in one task; a key with more is dealt by the hours of its rows
BUSY_ROWS = 1 << 20


def numbered_within(
    df: DataFrame, key: str, time: str, order: list[Column], name: str, sizes: DataFrame | None = None
) -> DataFrame:
    """Number all rows of each key from 1 in an order that begins with ``time`` (no nulls).

    The rows are shuffled once. Keys of over ``BUSY_ROWS`` rows are numbered hour by hour, and each hour
    then adds the rows of the hours before it; the others have no hour. ``sizes`` (key, ``rows``: at
    least as many as the key has here) saves counting ``df``; the list of busy keys, at most one for
    every ``BUSY_ROWS`` rows, is broadcast.
    """
    counts = df.groupBy(key).agg(F.count(F.lit(1)).alias("rows")) if sizes is None else sizes
    busy = counts.where(F.col("rows") > BUSY_ROWS).select(key, F.lit(True).alias("_busy"))
    if busy.isEmpty():
        return df.withColumn(name, F.row_number().over(Window.partitionBy(key).orderBy(*order)).cast("bigint"))
    hour = F.when(F.col("_busy"), F.date_trunc("hour", time))
    dealt = df.join(F.broadcast(busy), key, "left").withColumn("_hour", hour)
    hours = dealt.where("_busy").groupBy(key, "_hour").agg(F.count(F.lit(1)).alias("_rows"))
    earlier = Window.partitionBy(key).orderBy("_hour").rowsBetween(Window.unboundedPreceding, -1)
    before = hours.select(key, "_hour", F.coalesce(F.sum("_rows").over(earlier), F.lit(0)).alias("_before"))
    place = F.row_number().over(Window.partitionBy(key, "_hour").orderBy(*order))
    return (dealt.withColumn("_place", place).join(before, [key, "_hour"], "left")
            .withColumn(name, F.col("_place") + F.coalesce("_before", F.lit(0)))
            .drop("_busy", "_hour", "_place", "_before"))


def event_counts(iam: DataFrame, endpoint: DataFrame, traffic: DataFrame) -> DataFrame:
    """(user_id, rows): the events of all sources, those without a time included (``traffic``: see ``user_traffic``)."""
    def per_user(df: DataFrame) -> DataFrame:
        return df.where("user_id IS NOT NULL").groupBy(F.upper("user_id").alias("user_id")).agg(F.count(F.lit(1)).alias("rows"))

    each = per_user(iam).unionByName(per_user(endpoint)).unionByName(
        traffic.select("user_id", F.col("log_entries").alias("rows")))
    return each.groupBy("user_id").agg(F.sum("rows").alias("rows"))


def _events(df: DataFrame, order: list[Column], n: int | None) -> DataFrame:
    rows = df.where("user_id IS NOT NULL").withColumn("user_id", F.upper("user_id"))
    return rows if n is None else _earliest(rows, "user_id", order, n)


def _with_absent(df: DataFrame, **kinds: str) -> DataFrame:
    """``df`` with null columns for those it lacks, for readers of fewer columns."""
    return df.withColumns({name: F.lit(None).cast(kind) for name, kind in kinds.items() if name not in df.columns})


def _numbers(df: DataFrame) -> list[str]:
    return [c for c in df.columns if c == "event_no"]


IAM_ORDER = ("timestamp", "event_id", "event_type", "hostname")
ENDPOINT_ORDER = ("detected_timestamp", "alert_id", "alert_name", "hostname", "process_name")
FIREWALL_ORDER = ("timestamp", "log_id", "src_ip", "dst_ip", "src_port", "dst_port", "bytes_sent", "bytes_received")


def _by(columns: Sequence[str]) -> list[Column]:
    """Time first, unknown times last, then what tells rows of one time apart."""
    return [F.asc_nulls_last(columns[0]), *map(F.asc, columns[1:])]


def iam_events(iam: DataFrame, n: int | None = None) -> DataFrame:
    """A user's events, or its earliest n with their number. ``mfa_passed`` stays null where it is unknown."""
    rows = _events(_with_absent(iam, device_id="string", risk_level="string", geo_location="string", risk_score="double"), _by(IAM_ORDER), n)
    blank = ("event_id", "event_type", "auth_method", "source_ip", "hostname", "device_id",
             "risk_level", "failure_reason", "geo_location")
    return rows.select(
        "user_id", *_numbers(rows), "timestamp", "mfa_passed",
        F.coalesce("risk_score", F.lit(0.0)).alias("risk_score"),
        *[_text(c).alias(c) for c in blank],
    )


def endpoint_events(endpoint: DataFrame, n: int | None = None) -> DataFrame:
    rows = _events(_with_absent(endpoint, file_path="string", description="string"), _by(ENDPOINT_ORDER), n)
    return rows.select(
        "user_id", *_numbers(rows), "detected_timestamp", _text("alert_id").alias("alert_id"),
        _text("alert_name").alias("alert_name"),
        F.upper(_or("severity", "Medium")).alias("severity"), _or("status", "New").alias("status"),
        _or("process_name", "N/A").alias("process_name"), _or("file_path", "N/A").alias("file_path"),
        _or("hostname", "N/A").alias("hostname"), _or("description", "").alias("description"),
    )


def related_hosts(identity: DataFrame, iam: DataFrame, endpoint: DataFrame) -> DataFrame:
    """Distinct (user_id, host): the identity host and every host of the user's events."""
    def seen(df: DataFrame) -> DataFrame:
        return df.where("user_id IS NOT NULL").select(F.upper("user_id").alias("user_id"), F.col("hostname").alias("host"))

    hosts = (identity_context(identity).select("user_id", F.col("hostname").alias("host"))
             .unionByName(seen(iam)).unionByName(seen(endpoint).where("host <> 'N/A'")))
    return hosts.select("user_id", strip(F.col("host")).alias("host")).where("host <> ''").distinct()


def host_keys(hosts: DataFrame) -> DataFrame:
    return hosts.select("user_id", F.lower("host").alias("host_key")).distinct()


def _named(firewall: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Firewall rows once per name they can be found by: the short key (``match`` 1) and, where it
    differs, the full name (``match`` 2)."""
    short, full = F.lower("hostname_join_key"), F.lower("hostname")
    names = F.array(
        F.struct(F.lit(1).alias("match"), short.alias("host_key")),
        F.struct(F.lit(2).alias("match"), F.when(~short.eqNullSafe(full), full).alias("host_key")),
    )
    return firewall.select(*columns, F.inline(names)).where("host_key IS NOT NULL")


def _spelling() -> list[tuple[str, Column]]:
    """The two names of a firewall row as keys without nulls (none: empty), so that rows can be dealt and joined by them."""
    return [(key, F.coalesce(F.concat(F.lit("="), F.col(name)), F.lit("")))
            for key, name in (("_short", "hostname_join_key"), ("_full", "hostname"))]


def user_traffic(wanted: DataFrame, firewall: DataFrame) -> DataFrame:
    """Per user (``wanted``: user_id, host_key) the best match with bytes, rows and latest time of it.

    Traffic is added up per host and match before it meets the users, so a host that holds a
    third of all rows is one row in the join; users whose hosts have no row by the short key fall back
    to full names, decided on those sums. Rows are added up before a host gets its two names.
    """
    size = sum(F.coalesce(c, F.lit(0)).cast("bigint") for c in ("bytes_sent", "bytes_received"))
    sums = ("total_bytes", "log_entries", "latest")
    spelled = firewall.groupBy("hostname_join_key", "hostname").agg(
        F.sum(size).alias("total_bytes"), F.count(F.lit(1)).alias("log_entries"), F.max("timestamp").alias("latest"))
    per_host = _named(spelled, sums).groupBy("host_key", "match").agg(
        F.sum("total_bytes").alias("total_bytes"), F.sum("log_entries").alias("log_entries"), F.max("latest").alias("latest"))
    per_match = wanted.join(per_host, "host_key").groupBy("user_id", "match").agg(
        F.sum("total_bytes").alias("total_bytes"), F.sum("log_entries").alias("log_entries"), F.max("latest").alias("latest"))
    best = F.min(F.struct("match", "total_bytes", "log_entries", "latest")).alias("best")
    return per_match.groupBy("user_id").agg(best).select("user_id", "best.*")


def firewall_events(
    wanted: DataFrame, firewall: DataFrame, n: int | None = None, traffic: DataFrame | None = None
) -> DataFrame:
    """Firewall rows of a user's hosts (``wanted``: user_id, host_key), or its earliest n with their number.

    Only users without any row by the short key match full names; ``traffic`` is their ``user_traffic``, if it
    is at hand. With it, users meet the spellings of their hosts first, so each row is shuffled once, not once for each of its names.
    The earliest n rows of a user lie within the earliest n of each spelling (or name) of its hosts, so with n traffic is cut per
    spelling before it meets the users: a host shared by many users never multiplies its whole traffic. Rows stay
    dealt by spelling from that cut to the join.
    """
    columns = ("log_id", "timestamp", "hostname", "src_ip", "dst_ip", "src_port", "dst_port",
               "protocol", "action", "bytes_sent", "bytes_received", "threat_flag", "rule_name",
               "geo_country")
    order = _by(FIREWALL_ORDER)
    firewall = _with_absent(firewall, rule_name="string")
    if n is None and traffic is None:
        traffic = user_traffic(wanted, firewall)
    if traffic is None:
        keys = ["host_key", "match"]
        chosen = wanted.withColumn("match", F.explode(F.array(F.lit(1), F.lit(2))))
        rows = _named(firewall, columns)
    else:
        keys = [name for name, _ in _spelling()]
        spelled = firewall.select("hostname_join_key", "hostname").distinct()
        chosen = (wanted.join(traffic.select("user_id", "match"), "user_id")
                  .join(_named(spelled, spelled.columns), ["host_key", "match"])
                  .select("user_id", "match", *[spelling.alias(name) for name, spelling in _spelling()]))
        rows = firewall.select(*columns, *[spelling.alias(name) for name, spelling in _spelling()]).where(
            "NOT (_short = '' AND _full = '')")
    if n is None:
        matched = chosen.join(rows, keys)
    else:
        cut = _first_rows(rows, keys, order, n, "host_no").drop("host_no")
        # short-key rows come first, so the first n rows hold a user's short-key rows if it has any
        first = _first_rows(chosen.join(cut, keys), ["user_id"], [F.asc("match"), *order], n, "event_no")
        best = F.min("match").over(Window.partitionBy("user_id"))
        matched = first.withColumn("_best", best).where("match = _best")
    sent, received = (F.coalesce(c, F.lit(0)).cast("bigint") for c in ("bytes_sent", "bytes_received"))
    return matched.select(
        "user_id", *_numbers(matched), "timestamp",
        *[_text(c).alias(c) for c in (
            "log_id", "hostname", "src_ip", "dst_ip", "src_port", "dst_port", "rule_name", "geo_country")],
        _or("protocol", "TCP").alias("protocol"), _or("action", "ALLOW").alias("action"),
        sent.alias("bytes_sent"), received.alias("bytes_received"),
        (sent + received).alias("total_bytes"), "threat_flag",
    )


def latest_activity(iam: DataFrame, endpoint: DataFrame, traffic: DataFrame) -> DataFrame:
    """Per user the time of the latest event of any source (``traffic``: see ``user_traffic``)."""
    def times(df: DataFrame, time: str) -> DataFrame:
        return df.where("user_id IS NOT NULL").select(F.upper("user_id").alias("user_id"), F.col(time).alias("latest"))

    seen = times(iam, "timestamp").unionByName(times(endpoint, "detected_timestamp")).unionByName(
        traffic.select("user_id", "latest"))
    return seen.groupBy("user_id").agg(F.max("latest").alias("latest"))


# --- timeline ---------------------------------------------------------------------------------

def _tie(columns: Sequence[str]) -> Column:
    """What orders events of one source and time, as one text."""
    return F.concat_ws("|", *[F.coalesce(F.col(c).cast("string"), F.lit("")) for c in columns[1:]]).alias("tie")


def evidence_timeline(
    iam_part: DataFrame, endpoint_part: DataFrame, firewall_part: DataFrame, n: int | None = None,
    sizes: DataFrame | None = None,
) -> DataFrame:
    """The event lists of a user merged by time, all of it or the first n.

    The source order, then the order of the source's own list, breaks ties. ``sizes``: see ``event_counts``.
    """
    c, say = F.col, F.lit
    failed = as_flag(~c("mfa_passed")) | F.upper("event_type").contains("FAIL")
    mfa = F.coalesce(F.initcap(c("mfa_passed").cast("string")), say("Unknown"))
    from_iam = iam_part.select(
        "user_id", _tie(IAM_ORDER), say(1).alias("source_no"), "timestamp",
        say("IAM Audit Trail").alias("source"), "event_type",
        F.when(failed, "HIGH").otherwise("MEDIUM").alias("severity"),
        F.concat(
            say("Event: "), c("event_type"), say(", Method: "), c("auth_method"), say(", IP: "),
            c("source_ip"), say(", MFA: "), mfa,
            F.when(c("failure_reason") != "", F.concat(say(", Reason: "), c("failure_reason")))
            .otherwise(""),
        ).alias("details"),
    )
    from_endpoint = endpoint_part.select(
        "user_id", _tie(ENDPOINT_ORDER), say(2).alias("source_no"),
        c("detected_timestamp").alias("timestamp"), say("Endpoint Alert (EDR)").alias("source"),
        c("alert_name").alias("event_type"), "severity",
        F.concat(say("Process: "), c("process_name"), say(", Host: "), c("hostname"),
                 say(", Status: "), c("status")).alias("details"),
    )
    from_firewall = firewall_part.select(
        "user_id", _tie(FIREWALL_ORDER), say(3).alias("source_no"), "timestamp",
        say("Firewall Logs").alias("source"),
        F.concat(say("NETWORK_TRAFFIC ("), c("protocol"), say(")")).alias("event_type"),
        F.when(as_flag(c("threat_flag")), "CRITICAL")
        .when(c("total_bytes") > LARGE_TRANSFER_BYTES, "HIGH").otherwise("MEDIUM").alias("severity"),
        F.concat(
            say("Host: "), c("hostname"), say(", Dst: "), c("dst_ip"), say(":"), c("dst_port"),
            say(", Bytes: "), F.format_number("total_bytes", 0), say(", Action: "), c("action"),
            say(", Country: "), c("geo_country"),
        ).alias("details"),
    )
    merged = from_iam.unionByName(from_endpoint).unionByName(from_firewall)
    order = [F.asc("timestamp"), F.asc("source_no"), F.asc("tie"), F.asc("details")]
    timed = merged.where("timestamp IS NOT NULL")
    placed = (numbered_within(timed, "user_id", "timestamp", order, "position", sizes) if n is None
              else _earliest(timed, "user_id", order, n, "position"))
    return placed.drop("tie", "source_no")


def chart_points(timeline: DataFrame) -> DataFrame:
    level = F.lit(3)
    for name, value in (("CRITICAL", 10), ("HIGH", 7), ("MEDIUM", 4), ("LOW", 1)):
        level = F.when(F.upper("severity") == name, value).otherwise(level)
    return timeline.select(
        "user_id", "position", "timestamp", level.alias("severity_level"),
        F.col("source").alias("event_source"), "event_type")


# --- report -------------------------------------------------------------------------------

_FORMER = ("DISABLED", "INACTIVE", "TERMINATED")


def report_headers(identity: DataFrame, risk: DataFrame, latest: DataFrame) -> DataFrame:
    """One row per identity user: identification, score and the post-termination verdict.

    The verdict is the risk table's flag or, for accounts no longer active, any event of any source
    after the termination date (``latest``: see ``latest_activity``).
    """
    profile = risk_profile(risk).select(
        "user_id", "risk_score", F.upper("risk_band").alias("risk_band"), "risk_drivers",
        "post_termination_flag", "score_breakdown")
    former = F.upper("employment_status").isin(*_FORMER)
    after = as_flag(former & (F.col("latest") > F.col("termination_date")))
    return (
        identity_context(identity).select(
            "user_id", "user_name", "employment_status", "termination_date", "hostname",
            "device_id", "device_id_conflict", "device_user_count")
        .join(profile, "user_id", "left").join(latest, "user_id", "left")
        .withColumn("post_termination", as_flag(F.col("post_termination_flag")) | after)
        .withColumns({
            "risk_score": F.coalesce("risk_score", F.lit(0.0)),
            "risk_band": F.coalesce("risk_band", F.lit("LOW")),
        })
        .drop("latest", "post_termination_flag")
    )


def _line(section: str, part: int, order: Column, line: Column) -> Column:
    return F.struct(F.lit(section).alias("section"), F.lit(part).alias("part"),
                    order.cast("string").alias("line_order"), line.alias("line"))


def _inlined(df: DataFrame, *lines: Column) -> DataFrame:
    """One row per line (a null is none)."""
    return df.select("user_id", F.inline(F.filter(F.concat(*lines), lambda line: line.isNotNull())))


def report_lines(headers: DataFrame, threats: DataFrame, queue: DataFrame) -> DataFrame:
    """The report's lists in long form, ordered by (section, part, line_order).

    Two passes: the lines that follow from a user's facts, and those of each detection.
    """
    c, say = F.col, F.lit
    first = say("0")
    term = F.coalesce(c("termination_date").cast("string"), say(""))
    affected = threats.select("user_id").distinct().withColumn("has_threats", say(True))
    facts = headers.join(affected, "user_id", "left").join(
        queue.select("user_id", c("recommended_action").alias("queue_action")), "user_id", "left")
    quiet = c("has_threats").isNull()

    def driver(raw: Column, place: Column) -> Column:
        piece = strip(raw)
        return F.when((piece != "") & (piece != ROUTINE), _line("key_drivers", 1, place, F.concat(
            F.upper(F.substring(piece, 1, 1)), F.btrim(raw).substr(F.lit(2), F.length(raw)))))

    steps = F.filter(F.array_distinct(F.array(
        F.when(c("post_termination"), "Immediately revoke all active identity credentials, SSO "
                                      "tokens, and IAM session access."),
        F.when(c("post_termination") & (c("hostname") != ""), F.concat(
            say("Isolate assigned endpoint device ("), c("hostname"),
            say(") from the enterprise network."))),
        F.nullif("queue_action", say("")),
        F.when(c("risk_score") >= 80, "Escalate case to Tier 2 Incident Response Team for "
                                      "priority containment.")
        .when(c("risk_score") >= 50, "Schedule mandatory credential rotation and verify "
                                     "multi-factor authentication enrollment.")
        .otherwise("Continue standard telemetry monitoring in triage queue."),
        F.when(c("risk_score") >= 80, "Collect endpoint forensic memory dump and inspect "
                                      "authentication audit logs."),
    )), lambda s: s.isNotNull())
    of_users = _inlined(
        facts,
        F.transform(F.split(F.coalesce("risk_drivers", say("")), ";"), driver),
        F.array(
            F.when(quiet & (F.coalesce("risk_drivers", say(ROUTINE)) == ROUTINE),
                   _line("key_drivers", 3, first, say(ROUTINE))),
            F.when(c("post_termination"), _line("critical_findings", 1, first, F.concat(
                say("CRITICAL: Unauthorized post-termination activity detected for user "), c("user_id"),
                say(" ("), c("user_name"), say(") after termination date "), term, say(".")))),
            F.when(c("device_id_conflict"), _line("critical_findings", 3, first, F.concat(
                say("Device Ownership Conflict: Device "), c("device_id"), say(" is linked to "),
                c("device_user_count").cast("string"), say(" different users.")))),
            F.when(quiet & ~c("post_termination") & ~c("device_id_conflict"),
                   _line("critical_findings", 4, first, say(NO_FINDING)))),
        F.transform(steps, lambda step, place: _line("recommended_next_steps", 1, place, step)))
    severity = F.upper(_or("severity", "Medium"))
    of_threats = _inlined(
        threats.join(headers.select("user_id"), "user_id", "left_semi").withColumn("at", threat_order()),
        F.array(
            _line("key_drivers", 2, c("at"), F.concat(
                say("Active Threat Detection: "), c("threat_type"), say(" ("), severity, say(")"))),
            _line("critical_findings", 2, c("at"), F.concat(
                say("Threat Detection ["), c("threat_id"), say("]: "), c("threat_type"), say(" ("),
                severity, say(")"),
                F.when(_text("evidence") != "", F.concat(say(" — Evidence: "), c("evidence"))).otherwise("")))))
    return of_users.unionByName(of_threats)


# --- analyst summaries ------------------------------------------------------------------------

def critical_accounts(risk: DataFrame, n: int = 5) -> DataFrame:
    """The first n critical accounts by id; with none, the n highest scores."""
    critical = as_flag(F.lower("risk_level") == "critical")
    order = [F.desc("is_critical"), F.when(F.col("is_critical"), F.col("user_id")).asc_nulls_last(),
             F.desc("risk_score"), F.asc("user_id")]
    first = risk.withColumn("is_critical", critical).orderBy(*order).limit(n)
    # over the n rows left, not over the users
    any_critical = F.max("is_critical").over(Window.partitionBy())
    return first.withColumn("any_critical", any_critical).where("is_critical = any_critical").select(
        "user_id", "risk_score", "risk_level", "department", "risk_drivers")


def system_summary(threats: DataFrame, risk: DataFrame) -> DataFrame:
    critical = F.count(F.when(F.lower("risk_level") == "critical", 1))
    counts = threats.agg(F.count(F.lit(1)).alias("active_threat_detections"), F.lit(None).cast("bigint")
                         .alias("critical_risk_users"))
    users = risk.agg(F.lit(None).cast("bigint").alias("active_threat_detections"),
                     critical.alias("critical_risk_users"))
    return counts.unionByName(users).agg(
        *[F.max(n).alias(n) for n in ("active_threat_detections", "critical_risk_users")])


def primary_detections(threats: DataFrame, n: int = 5) -> DataFrame:
    """The first n rows of the published detection order."""
    return threats.orderBy("severity", "confidence", "threat_type", "threat_id").limit(n).select(
        "threat_id", "user_id", "threat_type", "severity")


def user_comparison(identity: DataFrame, risk: DataFrame, threats: DataFrame) -> DataFrame:
    first = F.min(F.struct(threat_order().alias("at"), "threat_type", F.upper("severity").alias("sev")))
    per_user = threats.groupBy("user_id").agg(F.count(F.lit(1)).alias("n"), first.alias("first"))
    return (
        identity_context(identity).select("user_id", "user_name", "employment_status")
        .join(risk_profile(risk).select("user_id", "risk_score", "risk_band"), "user_id", "left")
        .join(per_user, "user_id", "left").select(
            "user_id", "user_name", F.coalesce("risk_score", F.lit(0.0)).alias("risk_score"),
            F.upper(_or("risk_band", "Low")).alias("risk_band"), "employment_status",
            F.coalesce("n", F.lit(0)).alias("active_threat_detections"),
            F.concat(F.col("first.threat_type"), F.lit(" ("), F.col("first.sev"), F.lit(")"))
            .alias("primary_threat"))
    )


def traffic_volume(traffic: DataFrame) -> DataFrame:
    """The whole traffic of a user's hosts (see ``user_traffic``)."""
    return traffic.select("user_id", "total_bytes", "log_entries").withColumn("traffic_mb", two_decimals(F.col("total_bytes") / (1024 * 1024)))


def mfa_evidence(iam_part: DataFrame) -> DataFrame:
    """Events with a failed second factor or an MFA event type; unknown is not a failure."""
    return iam_part.where(as_flag(~F.col("mfa_passed")) | F.upper("event_type").contains("MFA"))


DOMAINS = ("identity", "risk", "threats", "iam", "endpoint", "firewall", "timeline")
_PLACES = {
    "threats": ("threat_order",), "iam": IAM_ORDER, "endpoint": ENDPOINT_ORDER, "firewall": FIREWALL_ORDER, "timeline": ("position",)}


def evidence_bundle(parts: dict[str, DataFrame], users: DataFrame) -> DataFrame:
    """The selected domains (see ``DOMAINS``) of the users in one long table.

    One row per (user, domain, record): ``place`` orders the records of a domain, ``payload`` is the record as a
    VARIANT. No list is ever gathered, so a domain may hold any number of records.
    """
    wanted = users.select("user_id").distinct()
    rows = None
    for name in DOMAINS:
        if name not in parts:
            continue
        part = parts[name]
        fields = [c for c in part.columns if c != "user_id"]
        place = [F.coalesce(F.lpad(F.col(c).cast("string"), 12, "0") if c == "position" else F.col(c).cast("string"), F.lit("~"))
                 for c in _PLACES.get(name, ())]
        record = part.select("user_id", F.lit(name).alias("domain"), F.concat_ws("|", *place).alias("place"),
                             F.to_variant_object(F.struct(*[_plain(part, c).alias(c) for c in fields])).alias("payload"))
        rows = record if rows is None else rows.unionByName(record)
    return rows.join(wanted, "user_id", "left_semi")


def _plain(df: DataFrame, name: str) -> Column:
    """Times as text, which every reader of a VARIANT understands alike."""
    kind = dict(df.dtypes)[name]
    return F.col(name).cast("string") if kind.startswith("timestamp") else F.col(name)
