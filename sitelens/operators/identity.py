"""Link patients to members, who share no key, into a one-to-one crosswalk.

Two records with the same normalized profile (names, birth date, gender, zip) get the
same candidates, and only the smallest id of the profile can win a contest.  So both
sides first collapse to profiles with their smallest id and their count.  Copies of
one record, however many, cost one row, and every "best of" is an aggregate that
combines map-side instead of a window over a group.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce
from types import MappingProxyType

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sitelens.functions.scale import broadcast_within, staged
from sitelens.functions.similarity import can_reach, jaro_winkler, name_signatures
from sitelens.functions.temporal import swapped_day_month
from sitelens.functions.text import normalized_name

THRESHOLD = 0.92  # fixed value: smallest accepted name similarity
KEY = ["fn", "ln", "dob"]
PROFILE = [*KEY, "gender", "zip"]
BLOCK = ["dob", "gender", "kind", "token"]
#: pairs of names in one block beyond which its names meet by signature
HOT_PAIRS = 50_000_000


def profiles(people: DataFrame, person_id: str, scope: Sequence[str], extra: Sequence[str]) -> DataFrame:
    """One row per distinct normalized record: its smallest id and how often it occurs."""
    normalized = people.select(
        *scope,
        person_id,
        normalized_name(F.col("first_name")).alias("fn"),
        normalized_name(F.col("last_name")).alias("ln"),
        "dob",
        "gender",
        "zip",
        *[F.lower(F.trim(F.col(c))).alias(c) for c in extra],
    )
    return normalized.groupBy(*scope, *PROFILE, *extra).agg(
        F.min(person_id).alias(person_id), F.count("*").alias("copies")
    )


def _name(fn: str, ln: str) -> Column:
    return F.concat(F.col(fn), F.lit(" "), F.col(ln))


def _resolve_ties(located: DataFrame, members: DataFrame, scope: Sequence[str]) -> DataFrame:
    """Several exact candidates: only an agreeing zip decides, then gender, then the id.

    The join is on the key *and* zip, so it fans out to the genders on file, not to
    every namesake.
    """
    p, m = located.filter("candidates > 1").alias("p"), members.alias("m")
    keys = reduce(
        lambda a, b: a & b, [F.col(f"p.{c}") == F.col(f"m.{c}") for c in (*KEY, "zip")]
    )
    same_gender = F.col("p.gender") == F.col("m.gender")
    order = F.when(same_gender, 0).when(same_gender.isNull(), 2).otherwise(1)
    return (
        p.join(m, keys)
        .groupBy(*[F.col(f"p.{c}") for c in scope], F.col("p.patient_id"))
        .agg(F.min(F.struct(order.alias("order"), F.col("m.member_id"))).alias("best"))
        .select(*scope, "patient_id", F.col("best.member_id").alias("member_id"))
    )


def _blocks(side: DataFrame, extra: Sequence[str], within: Sequence[str] = ()) -> DataFrame:
    """One row per blocking key of a profile: surname, zip, and any extra attribute.

    Columns ``within`` become part of the token, so that only rows equal in them meet.
    """
    tokens = {"ln": "ln", "zip": "zip", **{c: c for c in extra}}

    def token(c: str) -> Column:
        parts = [F.coalesce(F.col(w).cast("string"), F.lit("")) for w in within] + [F.col(c)]
        return reduce(lambda a, b: F.concat(a, F.lit("\x1f"), b), parts)

    entries = F.array(
        *[F.struct(F.lit(k).alias("kind"), token(c).alias("token")) for k, c in tokens.items()]
    )
    return (
        side.withColumn("_entry", F.explode(entries))
        .selectExpr("*", "_entry.kind", "_entry.token")
        .drop("_entry")
        .filter("token IS NOT NULL AND dob IS NOT NULL AND gender IS NOT NULL")
    )


def hot_blocks(wanted: DataFrame, offered: DataFrame) -> DataFrame | None:
    """Blocks in which more than ``HOT_PAIRS`` pairs of names would meet; None if there are none."""
    sides = [side.select(*BLOCK, F.lit(p).alias("p"), F.lit(1 - p).alias("m")) for side, p in ((wanted, 1), (offered, 0))]
    sizes = sides[0].unionByName(sides[1]).groupBy(*BLOCK).agg(F.sum("p").alias("p"), F.sum("m").alias("m"))
    hot = staged(sizes.filter(F.col("p") * F.col("m") > HOT_PAIRS).select(*BLOCK))
    return None if hot.isEmpty() else hot


def _once(kind: Column, ln: Column, m_ln: Column) -> Column:
    """Equal surnames meet in their own blocks and need not meet again."""
    return (kind == "ln") | ~ln.eqNullSafe(m_ln)


def _meeting(wanted: DataFrame, offered: DataFrame, keep: Sequence[str], on: Sequence[str], threshold: float) -> DataFrame:
    """``keep`` columns of ``wanted`` with m_fn, m_ln, member_id of the members in its block."""
    p, m = wanted.alias("p"), offered.alias("m")
    same = reduce(lambda a, b: a & b, [F.col(f"p.{c}") == F.col(f"m.{c}") for c in on])
    bound = can_reach(_name("p.fn", "p.ln"), _name("m.fn", "m.ln"), threshold)
    return p.join(m, same & _once(F.col("p.kind"), F.col("p.ln"), F.col("m.ln")) & bound).select(
        *[F.col(f"p.{c}") for c in keep], F.col("m.fn").alias("m_fn"), F.col("m.ln").alias("m_ln"), "m.member_id"
    )


def _meeting_by_signature(wanted: DataFrame, offered: DataFrame, keep: Sequence[str], threshold: float) -> DataFrame:
    """The same pairs, or a few more that cannot pass, from an equi-join on (block, signature).

    Only numbered names and signatures are shuffled; a pair that shares several signatures goes
    on once, after the bound was applied to it.
    """

    def signed(side: DataFrame, own: bool) -> DataFrame:
        name = _name("fn", "ln")
        # a name becomes hundreds of rows: dealt out before, as a few names would be one task
        dealt = side.repartition(int(side.sparkSession.conf.get("spark.sql.shuffle.partitions")), "_id")
        made = dealt.select("_id", *BLOCK, name.alias("name"), name_signatures(name, threshold, own).alias("_s"))
        return made.select("_id", *BLOCK, "name", F.explode("_s").alias("_s")).select(
            "_id", "name", F.xxhash64(*BLOCK, "_s").alias("sig")
        )

    numbered = [staged(side.withColumn("_id", F.monotonically_increasing_id())) for side in (wanted, offered)]
    p, m = signed(numbered[0], True).alias("p"), signed(numbered[1], False).alias("m")
    pairs = (
        p.join(m, (F.col("p.sig") == F.col("m.sig")) & can_reach(F.col("p.name"), F.col("m.name"), threshold))
        .select(F.col("p._id").alias("_p"), F.col("m._id").alias("_m"))
        .distinct()
    )
    p, m = numbered[0].alias("p"), numbered[1].alias("m")
    same = reduce(lambda a, b: a & b, [F.col(f"p.{c}") == F.col(f"m.{c}") for c in BLOCK])
    return (
        pairs.join(p, F.col("_p") == F.col("p._id"))
        .join(m, (F.col("_m") == F.col("m._id")) & same & _once(F.col("p.kind"), F.col("p.ln"), F.col("m.ln")))
        .select(*[F.col(f"p.{c}") for c in keep], F.col("m.fn").alias("m_fn"), F.col("m.ln").alias("m_ln"), "m.member_id")
    )


def _gate(threshold: float, strict: Mapping[str, float]) -> Column:
    """The similarity that a pair needs, by the attribute that brought it together."""
    gate = F.lit(threshold)
    for kind, least in strict.items():
        gate = F.when(F.col("kind") == kind, F.lit(max(least, threshold))).otherwise(gate)
    return gate


def similar_pairs(
    patients: DataFrame,
    members: DataFrame,
    threshold: float,
    scope: Sequence[str],
    extra: Sequence[str],
    strict: Mapping[str, float] = MappingProxyType({}),
    scoped_members: bool = False,
) -> DataFrame:
    """Best similar member per patient profile among those sharing a blocking key.

    "Same birth date and gender, and (same surname or same zip)" is an equi-join on
    (dob, gender, kind, token), one kind per alternative.  The similarity depends on
    the names alone, so both sides of the join are distinct names per block: any number
    of namesakes meets as one pair.  Within a block a necessary length and letter bound
    drops hopeless pairs before anything is sent to Python.  The names of a block with more
    than ``HOT_PAIRS`` pairs meet by signature, so that pairs the bound refutes do not even
    meet there; both ways find the same pairs.  The best member of a name is then handed
    back to every profile that bears it.

    ``strict`` names further attributes that bring names together, each with the similarity that a
    pair needs if nothing else corroborates it.  With ``scoped_members`` both sides carry the
    ``scope`` columns, and only rows of one scope meet.
    """
    within, extra = (scope if scoped_members else ()), [*extra, *strict]
    person = ["fn", "ln", *BLOCK]
    bearers = _blocks(patients, extra, within)
    wanted = staged(bearers.select(*scope, *person).distinct())
    offered = staged(_blocks(members, extra, within).groupBy(*person).agg(F.min("member_id").alias("member_id")))
    hot = hot_blocks(wanted, offered)
    if hot is None:
        met = _meeting(wanted, offered, [*scope, *person], BLOCK, threshold)
    else:
        calm = [side.join(broadcast_within(hot), BLOCK, "left_anti") for side in (wanted, offered)]
        met = _meeting(*calm, [*scope, *person], BLOCK, threshold).unionByName(
            _meeting_by_signature(*(side.join(broadcast_within(hot), BLOCK, "left_semi") for side in (wanted, offered)), [*scope, *person], threshold)
        )
    scored = met.select(
        *scope, *person, "member_id", jaro_winkler(_name("fn", "ln"), _name("m_fn", "m_ln")).alias("similarity")
    ).filter(F.col("similarity") >= _gate(threshold, strict))
    best = F.min(F.struct((-F.col("similarity")).alias("loss"), "member_id")).alias("best")
    by_name = scored.groupBy(*scope, *person).agg(best)
    return (
        bearers.select(*scope, *person, "patient_id")
        .join(by_name, [*scope, *person])
        .groupBy(*scope, "patient_id")
        .agg(F.min("best").alias("best"))
        .select(
            *scope,
            "patient_id",
            F.col("best.member_id").alias("member_id"),
            (-F.col("best.loss")).alias("match_confidence"),
        )
    )


def one_to_one(links: DataFrame, scope: Sequence[str] = ()) -> DataFrame:
    """Each member keeps its strongest patient; a patient that loses is dropped."""
    strongest = F.min(
        F.struct((-F.col("match_confidence")).alias("loss"), "match_method", "patient_id")
    )
    return (
        links.groupBy(*scope, "member_id")
        .agg(strongest.alias("best"))
        .select(
            *scope,
            F.col("best.patient_id").alias("patient_id"),
            "member_id",
            F.col("best.match_method").alias("match_method"),
            (-F.col("best.loss")).alias("match_confidence"),
        )
    )


def tiered_links(
    patients: DataFrame,
    members: DataFrame,
    threshold: float = THRESHOLD,
    scope: Sequence[str] = (),
    extra: Sequence[str] = (),
) -> tuple[DataFrame, DataFrame]:
    """Links before the one-to-one contest, and the staged patient profiles."""
    # both are read by several tiers below: written once each
    known = staged(profiles(members, "member_id", (), extra))
    namesakes = known.groupBy(*KEY).agg(
        F.sum("copies").alias("candidates"), F.min("member_id").alias("only_member")
    )
    located = staged(profiles(patients, "patient_id", scope, extra).join(namesakes, KEY, "left"))

    certain = F.lit(1.0).alias("match_confidence")
    unique = located.filter("candidates = 1").select(
        *scope, "patient_id", F.col("only_member").alias("member_id"), F.lit("exact").alias("match_method"), certain
    )
    ties = _resolve_ties(located, known, scope)
    resolved = ties.select(
        *scope, "patient_id", "member_id", F.lit("exact_tiebreak").alias("match_method"), certain
    )
    open_cases = located.filter("candidates IS NULL OR candidates > 1").join(
        ties, [*scope, "patient_id"], "left_anti"
    )
    fuzzy = similar_pairs(open_cases, known, threshold, scope, extra).withColumn(
        "match_method", F.lit("fuzzy")
    )
    return unique.unionByName(resolved).unionByName(fuzzy), located


def identity_xwalk(
    patients: DataFrame,
    members: DataFrame,
    threshold: float = THRESHOLD,
    scope: Sequence[str] = (),
    extra: Sequence[str] = (),
) -> DataFrame:
    """patient_id, member_id, match_method, match_confidence; one-to-one.

    ``scope`` columns of ``patients`` separate independent matching runs that share
    one pass over the members.  ``extra`` names attributes of both sides (address,
    phone, email) that corroborate a similar name as surname or zip do.
    """
    links, _ = tiered_links(patients, members, threshold, scope, extra)
    return one_to_one(links, scope)


def birth_date_variants(patients: DataFrame) -> DataFrame:
    """Each profile under the birth dates it may have been mistyped from."""
    dob = F.col("dob")
    variants = F.array_compact(
        F.array(F.date_add(dob, 1), F.date_sub(dob, 1), swapped_day_month(dob))
    )
    options = F.array_except(F.array_distinct(variants), F.array(dob))
    return patients.withColumn("dob", F.explode(options))


def identity_xwalk_with_variants(
    patients: DataFrame,
    members: DataFrame,
    threshold: float = THRESHOLD,
    variant_threshold: float = 0.96,
    lone_threshold: float = 0.98,
    scope: Sequence[str] = (),
) -> DataFrame:
    """The crosswalk, then a stricter pass over birth-date variants for who is left.

    Only patients with no link and members no patient holds take part.  A pair whose surname or
    zip agrees needs ``variant_threshold``; one that only shares the first name, whose surname and
    zip both disagree, needs ``lone_threshold``.  ``scope`` columns of ``patients`` (few values)
    separate independent runs, as in ``identity_xwalk``.
    """
    links, located = tiered_links(patients, members, threshold, scope)
    links = staged(links)
    base = staged(one_to_one(links, scope))
    left_patients = located.join(links.select(*scope, "patient_id"), [*scope, "patient_id"], "left_anti")
    offered = members
    if scope:
        present = located.select(*scope).distinct()
        runs = [r.asDict() for r in present.collect()]
        # typed, so that no runs at all still leave the scope columns
        entry = F.array(*[F.struct(*[F.lit(run[c]).alias(c) for c in scope]) for run in runs]).cast(f"array<{present.schema.simpleString()}>")
        offered = members.drop(*scope).withColumn("_run", F.explode(entry)).select("*", "_run.*").drop("_run")
    free = offered.join(base.select(*scope, "member_id"), [*scope, "member_id"], "left_anti")
    left_members = profiles(free, "member_id", scope, ())
    late = similar_pairs(
        birth_date_variants(left_patients), left_members, variant_threshold, scope, (), {"fn": lone_threshold}, bool(scope)
    ).withColumn("match_method", F.lit("fuzzy_dob"))
    return base.unionByName(one_to_one(late, scope))
