"""Entity resolution: names to ids, only when a second signal agrees.

Every tier is counted on aggregated keys (see `joins`): how many candidates, how many
the second signal keeps, and which one when it is exactly one. Ids are integers.
"""

from __future__ import annotations

from collections.abc import Sequence
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.text import normalize_name, squish, token_sort_key
from .joins import date_tolerance, family_build, family_probe, near_club_check, span_corroboration
from .reconcile import Folded, fold_cross_source
from ..session import written
from .skew import null_safe, ranged, shuffled, top_k


def canonical_entities(directory: DataFrame, profiles: DataFrame, key: str, stamp: str,
                       prefer_profile: Sequence[str], first_known: Sequence[str]) -> DataFrame:
    """One row per entity: newest directory entry, profile fields where they are filled,
    the earliest known value for the columns in `first_known`."""

    def known(c):
        return F.when(F.col(c).isNotNull() & (F.trim(F.col(c).cast("string")) != ""), F.col(c))

    latest = [c for c in directory.columns if c not in (key, stamp, *first_known)]
    d = directory.groupBy(key).agg(
        *[F.max_by(c, F.when(known(c).isNotNull(), F.col(stamp))).alias(c) for c in latest],
        *[F.min_by(c, F.when(known(c).isNotNull(), F.col(stamp))).alias(c) for c in first_known])
    p = profiles.groupBy(key).agg(
        *[F.max_by(c, F.when(known(c).isNotNull(), F.col(stamp))).alias(f"__p_{c}") for c in prefer_profile],
        F.lit(True).alias("__has"))
    out = d.join(p, key, "left")
    for c in prefer_profile:
        have = F.col(c) if c in out.columns else F.lit(None)
        out = out.withColumn(c, F.coalesce(F.col(f"__p_{c}"), have))
    return out.withColumn("has_profile", F.coalesce("__has", F.lit(False))).drop("__has", *[f"__p_{c}" for c in prefer_profile])


def alias_table(canon: DataFrame, ident: str, name: str, family: str, given: str, nickname: str, raw_given: str) -> DataFrame:
    """Every spelling an entity is looked up by, once per (id, normalised spelling, kind)."""
    fam, giv = F.nullif(squish(family), F.lit("")), F.nullif(squish(given), F.lit(""))
    nick, raw = F.nullif(squish(nickname), F.lit("")), F.nullif(squish(raw_given), F.lit(""))
    paternal, first = F.substring_index(fam, " ", 1), F.substring_index(giv, " ", 1)

    def comma(a, b):
        return F.concat(a, F.lit(", "), b)

    kinds = [("canonical", F.col(name)), ("normalized", normalize_name(name)),
             ("given_family_order", F.concat(giv, F.lit(" "), fam)), ("nickname", nick),
             ("nickname_surname", comma(paternal, nick)), ("raw", comma(fam, raw))]
    for s in (fam, paternal):
        kinds += [("paternal_surname", comma(s, giv)), ("given_first_only", F.when(first != giv, comma(s, first))),
                  ("initial", comma(s, F.concat(F.substring(first, 1, 1), F.lit("."))))]
    packed = F.array(*[F.struct(F.lit(k).alias("alias_type"), squish(a).alias("alias")) for k, a in kinds])
    out = (canon.select(ident, F.explode(packed).alias("__a")).select(ident, "__a.alias_type", "__a.alias")
           .where(F.col("alias") != "").withColumn("normalized_alias", normalize_name("alias")))
    return out.groupBy(ident, "normalized_alias", "alias_type").agg(F.min("alias").alias("alias"))


class Resolved(NamedTuple):
    decided: DataFrame   # every row of the second source with tier and entity id
    enriched: DataFrame
    minted: DataFrame
    review: DataFrame


def enrich_mint_review(second: DataFrame, canon: DataFrame, row_id: str, ident: str, mint_base: int,
                       bridge: DataFrame | None = None, days: int = 7) -> Resolved:
    """Second source onto the canonical one.

    Columns on both sides: name_key, family (array), given, birth_date, birth_year.
    bridge > exact name and year > family shape with a birth date within `days` (or equal
    years when a date is missing) > new id when nothing collides > review.
    """
    s = second.withColumn("__sid", F.col(row_id))
    canon = written(canon)
    if bridge is not None:
        s = null_safe(s, bridge.select("name_key", "birth_date", F.col("target").alias("__bridge")), ["name_key", "birth_date"])
    else:
        s = s.withColumn("__bridge", F.lit(None).cast("string"))
    by_year = canon.groupBy("name_key", "birth_year").agg(F.min(ident).alias("__e1"))
    by_name = canon.groupBy("name_key").agg(F.min(ident).alias("__e2"))
    s = written(s.join(by_year, ["name_key", "birth_year"], "left").join(by_name, "name_key", "left"))
    exact = F.when(F.col("birth_year").isNull(), F.col("__e2")).otherwise(F.col("__e1"))

    probe = family_probe(s, ["__sid", "birth_date", "birth_year"])
    build = family_build(canon, [ident, "birth_date", "birth_year"])
    near = (date_tolerance(probe.where(F.col("birth_date").isNotNull()), build, ["__f", "__g"], "birth_date", ident, days)
            .groupBy("__sid").agg(F.min("near_min").alias("__near")))
    # equal years, for pairs in which at least one side has no full date
    any_year = build.groupBy("__f", "__g", "birth_year").agg(
        F.min(ident).alias("__y_any"), F.min(F.when(F.col("birth_date").isNull(), F.col(ident))).alias("__y_undated"))
    year = (probe.join(shuffled(any_year), ["__f", "__g", "birth_year"])
            .groupBy("__sid").agg(F.min(F.when(F.col("birth_date").isNull(), F.col("__y_any"))
                                        .otherwise(F.col("__y_undated"))).alias("__year")))
    shape = (probe.join(shuffled(build.select("__f", "__g").distinct()), ["__f", "__g"], "left_semi")
             .select("__sid").distinct().withColumn("__shape", F.lit(True)))
    first_word = F.get("family", 0)
    same_year = (canon.where(F.col("birth_year").isNotNull()).select(first_word.alias("__w"), "birth_year").distinct()
                 .withColumn("__collide", F.lit(True)))
    s = (s.join(shuffled(near), "__sid", "left").join(shuffled(year), "__sid", "left").join(shuffled(shape), "__sid", "left")
         .withColumn("__w", first_word).join(same_year, ["__w", "birth_year"], "left"))
    by_shape = F.coalesce(F.least("__near", "__year"), F.col("__near"), F.col("__year"))
    collides = F.when(F.col("birth_year").isNotNull(), F.col("__collide")).otherwise(F.col("__shape"))
    forced = F.when(F.col("__bridge") != "review", F.col("__bridge").cast("long"))
    tier = (F.when(F.col("__bridge") == "review", "review").when(forced.isNotNull(), "bridge")
            .when(exact.isNotNull(), "exact").when(by_shape.isNotNull(), "family_shape")
            .when(F.coalesce(collides, F.lit(False)), "review").otherwise("mint"))
    s = s.withColumn("tier", tier).withColumn(ident, F.when(F.col("tier") == "bridge", forced)
                                               .when(F.col("tier") == "exact", exact)
                                               .when(F.col("tier") == "family_shape", by_shape))
    cols = [*second.columns, "tier", ident]
    s = written(s.select(*cols))
    order = [F.col("name_key"), F.col("birth_date").asc_nulls_first(), F.col(row_id)]
    minted = ranged(s.where(F.col("tier") == "mint").select(*cols), order, {"__no": F.lit(1).cast("long")})
    minted = minted.withColumn(ident, F.lit(mint_base) + F.col("__no")).select(*cols)
    enriched = s.where(F.col("tier").isin("bridge", "exact", "family_shape")).select(*cols)
    review = s.where(F.col("tier") == "review").select(*cols)
    return Resolved(enriched.unionByName(minted).unionByName(review), enriched, minted, review)


class Filled(NamedTuple):
    rows: DataFrame
    filled: DataFrame     # (key, field, value)
    conflicts: DataFrame  # (key, field, kept, offered)
    unmatched: DataFrame


def fill_empty(spine: DataFrame, source: DataFrame, key: str, fields: Sequence[str]) -> Filled:
    """Fill only empty fields, never overwrite; disagreements and unmatched rows are reported.

    Offers for one key that disagree fill nothing: the smallest and the largest are reported as conflicts.
    """
    offer = source.groupBy(key).agg(*[F.min(f).alias(f"__l_{f}") for f in fields], *[F.max(f).alias(f"__h_{f}") for f in fields])
    offer = offer.select(key, *[F.when(F.col(f"__l_{f}") == F.col(f"__h_{f}"), F.col(f"__h_{f}")).alias(f"__s_{f}") for f in fields],
                         *[F.when(F.col(f"__l_{f}") != F.col(f"__h_{f}"), F.array(f"__l_{f}", f"__h_{f}")).alias(f"__d_{f}") for f in fields])
    both = spine.join(offer, key, "left")
    rows = both.select(*[F.coalesce(F.col(c), F.col(f"__s_{c}")).alias(c) if c in fields else F.col(c) for c in spine.columns])
    packed = F.array(*[F.struct(F.lit(f).alias("field"), F.col(f).cast("string").alias("kept"),
                                F.col(f"__s_{f}").cast("string").alias("offered")) for f in fields])
    long = both.select(key, F.explode(packed).alias("__x")).select(key, "__x.*").where(F.col("offered").isNotNull())
    disputed = F.array(*[F.struct(F.lit(f).alias("field"), F.col(f).cast("string").alias("kept"),
                                  F.transform(f"__d_{f}", lambda x: x.cast("string")).alias("offered")) for f in fields])
    several = (both.select(key, F.explode(disputed).alias("__x")).select(key, "__x.field", "__x.kept", F.explode("__x.offered").alias("offered"))
               .where(F.col("kept").isNull() | (F.col("kept") != F.col("offered"))))
    return Filled(rows, long.where(F.col("kept").isNull()).select(key, "field", F.col("offered").alias("value")),
                  long.where(F.col("kept") != F.col("offered")).unionByName(several), source.join(spine, key, "left_anti"))


def seed_spans(canon: DataFrame, attested: DataFrame, index: DataFrame, ident: str, key: str, period: str,
               first: str, last: str) -> DataFrame:
    """Widen first/last season by attested seasons whose name has exactly one candidate."""
    unique = (index.groupBy(key).agg(F.min(ident).alias(ident), F.max(ident).alias("__m"))
              .where(F.col(ident) == F.col("__m")).drop("__m"))
    seen = (attested.groupBy(key).agg(F.min(period).alias("__lo"), F.max(period).alias("__hi")).join(unique, key)
            .groupBy(ident).agg(F.min("__lo").alias("__lo"), F.max("__hi").alias("__hi")))
    out = canon.join(seen, ident, "left")
    lo, hi = F.least(F.col(first), F.col("__lo")), F.greatest(F.col(last), F.col("__hi"))
    return (out.withColumn("seeded", ~(lo.eqNullSafe(F.col(first)) & hi.eqNullSafe(F.col(last))))
            .withColumn(first, lo).withColumn(last, hi).drop("__lo", "__hi"))


# --- observations to ids -----------------------------------------------------

CLIPPED = r"""\s*['"‘’“”][^'"‘’“”]*$"""


def observation_keys(df: DataFrame, raw: str) -> DataFrame:
    """The lookup keys of an observed name, one per tier."""
    clipped = F.regexp_replace(F.regexp_replace(F.col(raw), CLIPPED, ""), "^[ ,.]+|[ ,.]+$", "")
    head = F.filter(F.split(normalize_name(F.substring_index(F.col(raw), ",", 1)), " "), lambda t: t != "")
    tail = F.when(F.col(raw).contains(","), F.regexp_replace(F.col(raw), "^[^,]*,", "")).otherwise("")
    given = F.filter(F.split(normalize_name(tail), " "), lambda t: t != "")
    last = F.element_at(given, -1)
    st = F.get(head, 0)
    return df.withColumns({
        "alias_key": normalize_name(raw), "name_key": token_sort_key(raw),
        "clip_alias": F.when((clipped != F.col(raw)) & (clipped != ""), normalize_name(clipped)),
        "clip_name": F.when((clipped != F.col(raw)) & (clipped != ""), token_sort_key(clipped)),
        "trunc_key": F.when((F.size(given) > 0) & (F.length(last) >= 3), F.concat_ws("|", st, F.array_join(given, " "))),
        "surname_key": F.when(st.isNotNull(), F.concat_ws("|", st, F.coalesce(F.get(given, 0), F.lit("")))),
    })


def candidate_index(canon: DataFrame, aliases: DataFrame, ident: str, family: str, given: str, name: str,
                    overrides: DataFrame | None = None) -> DataFrame:
    """(lookup key, id), distinct. The key's first letter names its tier:
    o override, a alias, k token key, t truncated given name, s surname."""
    fam = F.filter(F.split(normalize_name(family), " "), lambda t: t != "")
    giv = F.filter(F.split(normalize_name(given), " "), lambda t: t != "")
    st = F.get(fam, 0)
    named = canon.select(ident, st.alias("st"), giv.alias("g"), F.col(name).alias("name")).where(F.col("st").isNotNull())
    cut = (named.select(ident, "st", "g", F.posexplode("g").alias("i", "w"))
           .withColumn("n", F.explode(F.when(F.length("w") > 3, F.sequence(F.lit(3), F.length("w") - 1))))
           .select(ident, F.concat(F.lit("t|"), F.concat_ws("|", "st", F.concat_ws(
               " ", F.slice("g", F.lit(1), F.col("i")), F.expr("left(w, n)")))).alias("ckey")))
    first = F.coalesce(F.get("g", F.lit(0)), F.lit(""))
    heads = F.concat(F.array(F.lit("")), F.when(first != "", F.transform(
        F.sequence(F.lit(1), F.length(first)), lambda n: F.substring(first, F.lit(1), n))).otherwise(F.array().cast("array<string>")))
    surname = named.select(ident, "st", F.explode(heads).alias("h")).select(
        ident, F.concat(F.lit("s|"), F.col("st"), F.lit("|"), F.col("h")).alias("ckey"))
    parts = [
        aliases.select(ident, F.concat(F.lit("a|"), F.col("normalized_alias")).alias("ckey")),
        aliases.select(ident, F.concat(F.lit("k|"), token_sort_key("alias")).alias("ckey")),
        named.select(ident, F.concat(F.lit("k|"), token_sort_key("name")).alias("ckey")), cut, surname,
    ]
    if overrides is not None:
        parts.append(overrides.select(ident, F.concat(F.lit("o|"), F.col("alias_key")).alias("ckey")))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out.distinct()


class ResolvedObservations(NamedTuple):
    decided: DataFrame
    mapped: DataFrame
    review: DataFrame


def resolve_observations(obs: DataFrame, index: DataFrame, spans: DataFrame, career: DataFrame, titles: DataFrame,
                         row_id: str, ident: str, period: str, club: str) -> ResolvedObservations:
    """Observation -> id, or a reason for review. `obs` carries `observation_keys`.

    spans: (id, lo, hi). career: (id, period, club). titles: (name_key, period).
    """
    obs, index = written(obs), written(index)
    sizes = written(index.groupBy("ckey").agg(F.count("*").alias("n_cands"), F.min(ident).alias("only_id")))

    # the first of override, alias and token key that names anybody is the candidate set
    out, kinds = obs, (("o", "alias_key"), ("a", "alias_key"), ("k", "name_key"))
    for tag, column in kinds:
        known = sizes.where(F.col("ckey").startswith(tag + "|")).select(
            F.col("ckey").alias(f"__{tag}"), F.col("n_cands").alias(f"__n_{tag}"), F.col("only_id").alias(f"__id_{tag}"))
        out = out.join(known, F.concat(F.lit(tag + "|"), F.col(column)) == F.col(f"__{tag}"), "left")
    out = out.select(*obs.columns, F.coalesce("__o", "__a", "__k").alias("ckey"),
                     F.coalesce("__n_o", "__n_a", "__n_k").alias("m_n_cands"),
                     F.coalesce("__id_o", "__id_a", "__id_k").alias("m_only_id"))
    out = written(out)

    # only observations nobody answers to go on to the weaker keys, at most four each
    def key(tag, kind, column):
        return F.when(F.col(column).isNotNull(), F.struct(
            F.lit(tag).alias("tag"), F.concat(F.lit(kind + "|"), F.col(column)).alias("ckey")))

    weaker = F.array_compact(F.array(key("clip_a", "a", "clip_alias"), key("clip_k", "k", "clip_name"),
                                     key("trunc", "t", "trunc_key"), key("surname", "s", "surname_key")))
    rest = (out.where(F.col("ckey").isNull()).select(row_id, period, club, F.explode(weaker).alias("__k"))
            .select(row_id, period, club, "__k.tag", "__k.ckey").join(sizes.select("ckey"), "ckey", "left_semi"))
    asked = (out.where(F.col("ckey").isNotNull()).select(row_id, period, club, F.lit("main").alias("tag"), "ckey")
             .unionByName(rest))
    # keys nobody asks for (most prefixes) leave before the index meets spans and careers
    index = written(index.join(asked.select("ckey").distinct(), "ckey", "left_semi"))
    spanned = index.join(spans, ident).select("ckey", ident, "lo", "hi")
    asked = span_corroboration(asked, spanned, "ckey", period, ident, "lo", "hi")
    near = (career.where(F.col(club).isNotNull()).select(ident, club, F.explode(F.sequence(F.col(period) - 1, F.col(period) + 1)).alias(period))
            .distinct().join(index, ident).groupBy("ckey", period, club)
            .agg(F.count("*").alias("n_club"), F.min(ident).alias("club_id")))
    asked = asked.join(near, ["ckey", period, club], "left")

    def of(tag, c, name):
        return F.max(F.when(F.col("tag") == tag, F.col(c))).alias(name)

    span, by_club = ("n_in_span", "survivor_id"), ("n_club", "club_id")
    flat = asked.groupBy(row_id).agg(
        *[of("main", c, f"m_{c}") for c in (*span, *by_club)], *[of("clip_a", c, f"a_{c}") for c in span],
        *[of("clip_k", c, f"k_{c}") for c in span], *[of("trunc", c, f"trunc__{c}") for c in span],
        *[of("surname", c, f"surname__{c}") for c in by_club])
    out = out.join(flat, row_id, "left")
    # a clipped name falls back to its token key only where no alias has it
    out = out.withColumns({f"c_{c}": F.when(F.col("a_n_in_span").isNotNull(), F.col(f"a_{c}")).otherwise(F.col(f"k_{c}")) for c in span})
    attested = titles.select("name_key", period).distinct().withColumn("__title", F.lit(True))
    out = out.join(attested, ["name_key", period], "left")
    n, corr = F.coalesce("m_n_cands", F.lit(0)), F.coalesce("m_n_in_span", F.lit(0))
    dated = F.col(period).isNotNull()
    rules = [
        (corr == 1, "name+season_in_career", "m_survivor_id"),
        ((n == 1) & F.col("__title") & dated, "name+season+title", "m_only_id"),
        ((corr > 1) & (F.col("m_n_club") == 1), "name+season+club", "m_club_id"),
        ((n == 1) & (corr == 0), "unique name, season outside the known span", None),
        (corr > 1, "several candidates in the season span", None),
        (n > 0, "several candidates, none in the season span", None),
        (dated & (F.col("c_n_in_span") == 1), "name+season+trunc", "c_survivor_id"),
        (dated & (F.col("trunc__n_in_span") == 1), "name+season+trunc", "trunc__survivor_id"),
        (dated & (F.col("surname__n_club") == 1), "surname+season+club", "surname__club_id"),
    ]
    method, found = F.lit("no canonical name match"), F.lit(None)
    for cond, label, src in reversed(rules):
        method = F.when(cond, label).otherwise(method)
        found = F.when(cond, F.col(src) if src else F.lit(None)).otherwise(found)
    out = out.withColumn("outcome", method).withColumn(ident, found.cast("long")).withColumn("n_candidates", n)
    out = out.select(*obs.columns, "outcome", ident, "n_candidates")
    checked = near_club_check(out, career.select(ident, period, club), ident, period, club)
    decided = checked.withColumn("club_check", F.when(F.col(ident).isNotNull(), F.col("club_check")))
    return ResolvedObservations(decided, decided.where(F.col(ident).isNotNull()), decided.where(F.col(ident).isNull()))


def match_tiers(obs: DataFrame, canon: DataFrame, row_id: str, ident: str, prior: DataFrame | None = None) -> DataFrame:
    """Tier 1-5 proposal per observation by birth evidence. Nothing is merged here.

    obs: family, given, exact_birth, approx_birth. canon: family, given, birth_year.
    Earlier human decisions (row_id, disposition) are carried over.
    """
    probe = family_probe(obs, [row_id, "exact_birth", "approx_birth"])
    build = family_build(canon, [ident, "birth_year"])
    sizes = build.groupBy("__f", "__g").agg(
        F.count("*").alias("__n"), F.count_if(F.col("birth_year").isNull()).alias("__n_blank"), F.min(ident).alias("__lo"),
        F.min(F.when(F.col("birth_year").isNull(), F.col(ident))).alias("__lo_blank"))
    by_year = build.where(F.col("birth_year").isNotNull()).groupBy("__f", "__g", "birth_year").agg(
        F.count("*").alias("__n_agree"), F.min(ident).alias("__lo_agree"))
    years = F.when(F.col("exact_birth").isNotNull(), F.array("exact_birth")).when(
        F.col("approx_birth").isNotNull(), F.array(F.col("approx_birth") - 1, F.col("approx_birth"), F.col("approx_birth") + 1))
    agree = (probe.withColumn("birth_year", F.explode(years)).join(shuffled(by_year), ["__f", "__g", "birth_year"])
             .groupBy(row_id).agg(F.sum("__n_agree").alias("__n_agree"), F.min("__lo_agree").alias("__lo_agree")))
    total = (probe.join(shuffled(sizes), ["__f", "__g"]).groupBy(row_id)
             .agg(F.sum("__n").alias("__n"), F.sum("__n_blank").alias("__n_blank"), F.min("__lo").alias("__lo"), F.min("__lo_blank").alias("__lo_blank")))
    out = obs.join(shuffled(total), row_id, "left").join(shuffled(agree), row_id, "left").fillna(0, ["__n", "__n_blank", "__n_agree"])
    silent = F.col("exact_birth").isNull() & F.col("approx_birth").isNull()
    against = F.col("__n") - F.col("__n_blank") - F.col("__n_agree")
    tier = (F.when(F.col("__n") == 0, "5_no_canonical_match")
            .when(silent & (F.col("__n") == 1), "3_no_birth_data_name_shape").when(silent, "4_ambiguous_multi_candidate")
            .when((F.col("__n_agree") == 1) & F.col("exact_birth").isNotNull(), "1_exact_birth_confirmed")
            .when(F.col("__n_agree") == 1, "2_approx_birth_confirmed")
            .when(F.col("__n_agree") > 1, "4_ambiguous_multi_candidate")
            .when((F.col("__n_blank") == 1) & (against == 0), "3_no_birth_data_name_shape")
            .when(F.col("__n_blank") > 0, "4_ambiguous_multi_candidate").otherwise("5_no_canonical_match"))
    proposed = (F.when(F.col("tier").startswith("1") | F.col("tier").startswith("2"), F.col("__lo_agree"))
                .when(F.col("tier").startswith("3"), F.when(silent, F.col("__lo")).otherwise(F.col("__lo_blank"))))
    out = out.withColumn("tier", tier).withColumn("candidate_id", proposed).select(
        *obs.columns, "tier", "candidate_id", F.col("__n").alias("n_candidates"))
    if prior is not None:
        out = out.join(shuffled(prior.select(row_id, "disposition")), row_id, "left")
    return out


class Promoted(NamedTuple):
    rows: DataFrame
    untraced: DataFrame    # confirmed rows without a raw row: must be empty
    duplicates: DataFrame  # repeated keys: must be empty


def promote_confirmed(matches: DataFrame, raw: DataFrame, trace: Sequence[str], ident: str, unique: Sequence[str],
                      tombstones: DataFrame | None = None) -> Promoted:
    """Confirmed rows under their lowest candidate id (or its survivor), with the raw row's facts."""
    rows = matches.where(F.col("disposition") == "confirmed_match").withColumn(ident, F.array_min("candidate_ids"))
    if tombstones is not None:
        rows = (rows.join(tombstones.select(F.col("retired_id").alias(ident), "survivor_id"), ident, "left")
                .withColumn(ident, F.coalesce("survivor_id", ident)).drop("survivor_id"))
    out = rows.join(raw, list(trace))
    dup = out.groupBy(*unique).agg(F.count("*").alias("n_rows")).where(F.col("n_rows") > 1)
    return Promoted(out, rows.join(raw, list(trace), "left_anti"), dup)


def invalid_merges(decisions: DataFrame, tombstones: DataFrame) -> DataFrame:
    """Problems in the curated merge files; empty when they are consistent.

    decisions: decision_id, kind, ids (array), survivor_id, evidence.
    """
    d = decisions.withColumn("n", F.size(F.array_distinct("ids")))
    problems = [
        d.groupBy("decision_id").agg(F.count("*").alias("n")).where("n > 1").select("decision_id", F.lit("duplicate decision").alias("problem")),
        d.where(~F.col("kind").isin("merge", "not_same")).select("decision_id", F.lit("unknown kind").alias("problem")),
        d.where((F.col("n") < 2) | (F.col("n") != F.size("ids"))).select("decision_id", F.lit("needs two distinct ids").alias("problem")),
        d.where((F.col("kind") == "merge") & ~F.coalesce(F.array_contains("ids", F.col("survivor_id")), F.lit(False))).select("decision_id", F.lit("survivor not among ids").alias("problem")),
        d.where((F.col("kind") == "not_same") & (F.col("survivor_id").isNotNull() | (F.col("n") != 2))).select("decision_id", F.lit("not_same takes two ids and no survivor").alias("problem")),
        d.where(F.coalesce(F.trim("evidence"), F.lit("")) == "").select("decision_id", F.lit("no evidence").alias("problem")),
    ]
    retired = tombstones.groupBy("retired_id").agg(F.count("*").alias("n"), F.min("decision_id").alias("decision_id"))
    problems.append(retired.where("n > 1").select("decision_id", F.lit("retired twice").alias("problem")))
    problems.append(tombstones.where(F.col("retired_id") == F.col("survivor_id")).select("decision_id", F.lit("retired into itself").alias("problem")))
    gone = tombstones.select(F.col("retired_id").alias("survivor_id"))
    problems.append(tombstones.join(gone, "survivor_id", "left_semi").select("decision_id", F.lit("survivor is itself retired").alias("problem")))
    backed = tombstones.join(d.where(F.col("kind") == "merge").select("decision_id", F.col("survivor_id").alias("__s"), "ids"), "decision_id", "left")
    problems.append(backed.where(~F.coalesce((F.col("__s") == F.col("survivor_id")) & F.array_contains("ids", F.col("retired_id")), F.lit(False)))
                    .select("decision_id", F.lit("no merge decision behind it").alias("problem")))
    pairs = d.where((F.col("kind") == "not_same") & (F.col("n") == 2)).select("decision_id", F.explode("ids").alias("retired_id"))
    ends = (pairs.join(tombstones.select("retired_id", "survivor_id").dropDuplicates(["retired_id"]), "retired_id", "left")
            .groupBy("decision_id").agg(F.count_distinct(F.coalesce("survivor_id", "retired_id")).alias("n")))
    problems.append(ends.where("n = 1").select("decision_id", F.lit("recorded as different but merged").alias("problem")))
    out = problems[0]
    for p in problems[1:]:
        out = out.unionByName(p)
    return out


class Merged(NamedTuple):
    rows: DataFrame
    dropped: DataFrame


def apply_merges(df: DataFrame, tombstones: DataFrame, ident: str, same: Sequence[str], order: Sequence[Column]) -> Merged:
    """Re-point retired ids to their survivor. A moved row equal (on `same`) to one the survivor
    has, or to an earlier moved one, is dropped and logged; untouched rows never are."""
    t = tombstones.select(F.col("retired_id").alias(ident), F.col("survivor_id").alias("__to"))
    out = df.join(t, ident, "left")
    stay = out.where(F.col("__to").isNull()).select(*df.columns)
    moved = out.where(F.col("__to").isNotNull()).withColumn("retired_id", F.col(ident)).withColumn(ident, F.col("__to")).drop("__to")
    key = [ident, *same]
    held = stay.select(*key).distinct().withColumn("__held", F.lit(True))
    turn = Window.partitionBy(*key).orderBy(*order, F.col("retired_id"), F.xxhash64(*df.columns))
    ranked = null_safe(moved.withColumn("__turn", F.row_number().over(turn)), held, key)
    first = F.col("__held").isNull() & (F.col("__turn") == 1)
    return Merged(stay.unionByName(ranked.where(first).select(*df.columns)), ranked.where(~first).drop("__held", "__turn"))


def remap_id_lists(df: DataFrame, tombstones: DataFrame, row_id: str, column: str) -> DataFrame:
    """Survivors in place of retired ids inside a list column, first occurrence kept."""
    items = df.select(row_id, F.posexplode(column).alias("__i", "__id"))
    t = tombstones.select(F.col("retired_id").alias("__id"), "survivor_id")
    back = (items.join(t, "__id", "left").withColumn("__id", F.coalesce("survivor_id", "__id"))
            .groupBy(row_id, "__id").agg(F.min("__i").alias("__i"))
            .groupBy(row_id).agg(F.transform(F.sort_array(F.collect_list(F.struct("__i", "__id"))), lambda x: x["__id"]).alias("__list")))
    return df.join(back, row_id, "left").withColumn(column, F.coalesce("__list", column)).drop("__list")


def merge_then_fold(career: DataFrame, tombstones: DataFrame, ident: str, period: str, team: str, stats: Sequence[str],
                    source: str, second: str, franchise: Column) -> tuple[Merged, Folded]:
    """The career table after a merge: identical rows dropped, then the cross-source fold."""
    from ..functions.text import city_token

    keyed = career.withColumn("__city", city_token(team))
    merged = apply_merges(keyed, tombstones, ident, [source, period, "__city", *stats], [F.col(team)])
    rows = merged.rows.drop("__city")
    return Merged(rows, merged.dropped.drop("__city")), fold_cross_source(
        rows, ident, period, team, stats, source, second, franchise)
