"""Promoter motif pairs and terminators on upstream and downstream windows."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from spanforge.functions.sequence import count_letters, let, mismatches, motif_hits, runs

#: The two pair motifs, an older form of the first, the third motif, and the terminator's run.
USE, TATA, CLASSIC, MSP, T_RUN = "RTMCCACATCG", "TTTATATA", "RTCCCACATCG", "RGCCCR", 4
#: Most mismatches of a motif in a pair that is reported.
MOST = 3


@dataclass(frozen=True)
class Profile:
    """Windows that the motifs may start in, and the classes of a pair (fixed values)."""

    use_window: tuple[int, int] = (-90, -45)
    tata_window: tuple[int, int] = (-42, -18)
    strict: tuple[int, int, int, int, int, int] = (1, 2, -35, -25, 24, 26)
    relaxed: tuple[int, int, int] = (2, 21, 29)
    #: Names of the pair's classes; the calibrated profile alone keeps placeholders with more than MOST mismatches.
    legacy: bool = True


LEGACY = Profile()
GENERIC = Profile(use_window=(-120, -40), tata_window=(-55, -15), legacy=False)
CLASSES = ("P1_canonical_geometry", "P2_near_canonical_geometry", "P3_uncertain")
PROVISIONAL = ("provisional_type3_like_geometry", "provisional_uncertain_geometry")


def _pair(x: Column, y: Column, profile: Profile) -> Column:
    """A first and a second motif (start, mm) as a pair, in the order of preference: class (0 strict, 1 relaxed, 2 other),
    mismatches, distance from the ideal geometry, then the leftmost."""
    u, t, low, high, e1, e2 = profile.strict
    mm, r1, r2 = profile.relaxed
    edge = y["start"] - x["start"] - len(USE) + 1
    strict = (x["mm"] <= u) & (y["mm"] <= t) & y["start"].between(low, high) & edge.between(e1, e2)
    rank = F.when(strict, 0).when((x["mm"] <= mm) & (y["mm"] <= mm) & edge.between(r1, r2), 1).otherwise(2)
    return F.struct(rank.alias("rank"), (x["mm"] + y["mm"]).alias("sum"), F.abs(edge - 24.5).alias("d1"), (F.abs(x["start"] + 65.5) + F.abs(y["start"] + 31)).alias("d2"), x["start"].alias("use_start"), y["start"].alias("tata_start"), x["mm"].alias("use_mm"), y["mm"].alias("tata_mm"))


def _later(x: Column, seconds: Column) -> Column:
    return F.filter(seconds, lambda y: y["start"] > x["start"] + len(USE) - 1)


def _product(firsts: Column, seconds: Column, profile: Profile) -> Column:
    return F.flatten(F.transform(firsts, lambda x: F.transform(_later(x, seconds), lambda y: _pair(x, y, profile))))


def motif_pairs(windows: DataFrame, profile: Profile = LEGACY, most: int = MOST) -> DataFrame:
    """id and every pair of a USE and a later TATA within the profile's windows, with at most ``most`` mismatches each.
    windows: id and seq, the bases before +1. The pairs of a window are bounded by the profile, not by the data."""
    first = -F.length("seq")
    found = windows.select("id", motif_hits(F.col("seq"), first, USE, *profile.use_window, most).alias("use"), motif_hits(F.col("seq"), first, TATA, *profile.tata_window, most).alias("tata"))
    p = found.select("id", F.explode(_product(F.col("use"), F.col("tata"), profile)).alias("p"))
    return p.select("id", "p.use_start", "p.use_mm", "p.tata_start", "p.tata_mm", (F.col("p.tata_start") - F.col("p.use_start") - len(USE) + 1).alias("edge"), F.col("p.rank").alias("pair_class"), (F.col("p.tata_start") - F.col("p.use_start")).alias("separation"))


def _chosen(windows: DataFrame, profile: Profile, most: int) -> DataFrame:
    """windows (seq: upper case, not null) with use, tata and msp (all their places), n_pairs and _best, the preferred pair
    of at most ``most`` mismatches each.

    Few pairs are made. Classes 0 and 1 need few mismatches in both motifs, so their pairs are among few hits. All others
    go by their mismatches first: where some hits of the fewest mismatches of either motif stand in order, none else can
    be preferred; only where they do not are all pairs made."""
    first = -F.length("seq")
    # The hits are bounded by the profile's windows, whatever the length of the sequence.
    each = F.struct(motif_hits(F.col("seq"), first, USE, *profile.use_window, len(USE)).alias("use"), motif_hits(F.col("seq"), first, TATA, *profile.tata_window, len(TATA)).alias("tata"), motif_hits(F.col("seq"), first, MSP, -(1 << 30), -1, 0).alias("msp"))

    def at_most(hits: Column, n) -> Column:
        return F.filter(hits, lambda h: h["mm"] <= n)

    def judged(x: Column) -> Column:
        return let(F.struct(at_most(x["use"], most).alias("use"), at_most(x["tata"], most).alias("tata")), lambda some: told(x, some))

    def told(all_: Column, x: Column) -> Column:
        close = max(profile.strict[0], profile.strict[1], profile.relaxed[0])
        fewest = lambda hits: let(F.array_min(F.transform(hits, lambda h: h["mm"])), lambda n: at_most(hits, n))
        sides = F.struct(fewest(x["use"]).alias("u"), fewest(x["tata"]).alias("t"))
        good = F.filter(_product(at_most(x["use"], close), at_most(x["tata"], close), profile), lambda p: p["rank"] < 2)

        def others(f: Column) -> Column:
            ordered = F.array_max(F.transform(f["t"], lambda h: h["start"])) > F.array_min(F.transform(f["u"], lambda h: h["start"])) + len(USE) - 1
            return F.when(F.coalesce(ordered, F.lit(False)), F.array_min(_product(f["u"], f["t"], profile))).otherwise(F.array_min(_product(x["use"], x["tata"], profile)))

        best = let(F.array_min(good), lambda p: F.when(p.isNotNull(), p).otherwise(let(sides, others)))
        reported = let(at_most(x["tata"], MOST), lambda t: F.aggregate(at_most(x["use"], MOST), F.lit(0), lambda n, u: n + F.size(_later(u, t))))
        return F.struct(all_["use"].alias("use"), all_["tata"].alias("tata"), all_["msp"].alias("msp"), best.alias("_best"), reported.alias("n_pairs"))

    return windows.select("*", F.inline(F.transform(F.array(each), judged)))


def best_pair(windows: DataFrame, profile: Profile = LEGACY, most: int = MOST) -> DataFrame:
    """The preferred pair of each window (id, seq) that has one of at most ``most`` mismatches each."""
    found = _chosen(windows.where("seq is not null").select("id", F.upper("seq").alias("seq")), profile, most).where("_best is not null").select("id", "_best.*")
    return found.select("id", "use_start", "tata_start", F.col("rank").alias("pair_class"), "use_mm", "tata_mm", (F.col("tata_start") - F.col("use_start") - len(USE) + 1).alias("edge"))


def scan(windows: DataFrame, profile: Profile = LEGACY) -> DataFrame:
    """One row for each window (id, seq: the bases before +1): scan_status, the chosen pair with its class, basis and four
    spacing metrics (nulls where there is none), pairs (how many have at most MOST mismatches in each motif), and the
    exact third-motif hits. The chosen pair is that of least class, mismatches, distance from the ideal geometry, and
    leftmost start. Hits of the third motif that end at or after the start of a reliable pair's first motif are dropped;
    beside an unreliable pair all stay. A null sequence counts as empty."""
    first = -F.length("seq")
    most = MOST if not profile.legacy else max(len(USE), len(TATA))
    text = windows.withColumn("seq", F.coalesce(F.upper("seq"), F.lit("")))
    mm, r1, r2 = profile.relaxed
    at = lambda start, n: F.substring(F.col("seq"), start - first + 1, F.lit(n))
    found = _chosen(text, profile, most)
    b = F.col("_best")
    found = found.withColumns({"use_sequence": F.when(b.isNotNull(), at(b["use_start"], len(USE))), "tata_sequence": F.when(b.isNotNull(), at(b["tata_start"], len(TATA)))})
    both = F.concat("use_sequence", "tata_sequence")
    found = found.withColumn("motif_ambiguous", F.length(both) - count_letters(both, "ACGT"))
    plain, edge = F.col("motif_ambiguous") == 0, b["tata_start"] - b["use_start"] - len(USE) + 1
    if profile.legacy:
        name = F.when(b["rank"] == 0, CLASSES[0]).when(b["rank"] == 1, CLASSES[1]).when(b["rank"] == 2, CLASSES[2])
        basis = F.when(b["rank"] < 2, "canonical_geometry_then_minimum_mismatch").when(b["rank"] == 2, "algorithm_minimum_mismatch_P3_not_a_functional_best_pair")
        reliable = (b["rank"] < 2) & plain
    else:
        relaxed = (b["use_mm"] <= mm) & (b["tata_mm"] <= mm) & edge.between(r1, r2)
        name = F.when(relaxed & plain, PROVISIONAL[0]).when(b.isNotNull(), PROVISIONAL[1])
        basis = F.when(b.isNotNull(), "provisional_Arabidopsis_motif_heuristic_not_cross_plant_calibrated")
        reliable = relaxed & plain
    reliable = F.coalesce(reliable, F.lit(False))
    complete = (first <= profile.use_window[0]) & (F.lit(-1) >= profile.tata_window[1] + len(TATA) - 1)
    msp = F.filter("msp", lambda h: ~F.col("_reliable") | (h["start"] + len(MSP) - 1 < b["use_start"]))
    found = found.withColumn("_reliable", reliable)
    return found.select(
        "id", F.when(complete, "complete_window").when((F.size("use") > 0) & (F.size("tata") > 0), "partial_window").otherwise("insufficient_window").alias("scan_status"),
        F.when(F.col("_reliable"), "paired_heuristic_evidence").otherwise("uncertain_or_no_pair_not_U6_exclusion").alias("evidence_status"), name.alias("pair_class"), basis.alias("selection_basis"),
        "use_sequence", b["use_start"].alias("use_start"), (b["use_start"] + len(USE) - 1).alias("use_end"), b["use_mm"].alias("use_mm"), F.when(b.isNotNull(), mismatches(F.col("use_sequence"), CLASSIC)).alias("classic_mm"),
        "tata_sequence", b["tata_start"].alias("tata_start"), (b["tata_start"] + len(TATA) - 1).alias("tata_end"), b["tata_mm"].alias("tata_mm"),
        (b["tata_start"] - b["use_start"]).alias("start_separation"), edge.alias("edge_distance"), (edge - 1).alias("intervening_bases"), (b["tata_start"] - b["use_start"] + (len(TATA) - len(USE)) / 2).alias("center_distance"),
        "motif_ambiguous", "n_pairs", F.array_join(F.transform(msp, lambda h: F.format_string("%d..%d", h["start"], h["start"] + len(MSP) - 1)), ",").alias("msp_hits"),
        F.when(F.col("_reliable"), "upstream_of_selected_USE").otherwise("USE_relation_unresolved").alias("msp_relation"), (F.length("seq") - count_letters(F.col("seq"), "ACGT")).alias("sequence_ambiguous"),
    )


def exact_hits(windows: DataFrame, motif: str, low: int, high: int) -> DataFrame:
    """id and start of exact occurrences of a motif that start in low..high."""
    return windows.select("id", F.explode(motif_hits(F.col("seq"), -F.length("seq"), motif, low, high, 0)).alias("h")).select("id", F.col("h.start").alias("start"))


def termination(bodies: DataFrame) -> DataFrame:
    """State of the expected terminator of each body and the lists of T runs. bodies: id, seq (from +1 on) and span, the
    body's length; a span of 0 or less raises. Expected runs start in span-15..span+30 (from 1); internal ones end before
    it. State: yes, no (the window is seen whole and has no ambiguous base) or not_fully_assessable."""
    span = F.when(F.col("span") > 0, F.col("span")).otherwise(F.raise_error(F.lit("span must be positive")).cast("int"))

    def judged(x: Column) -> Column:
        low, high, size = F.greatest(F.lit(1), x["span"] - 15), x["span"] + 30, F.length(x["seq"])
        seen = F.least(size, high)
        window = F.substring(x["seq"], low, F.greatest(F.lit(0), seen - low + 1))
        ambiguous = F.length(window) - count_letters(window, "ACGT")
        expected = F.filter(x["runs"], lambda r: r["start"].between(low, seen))
        nearest = F.array_min(F.transform(expected, lambda r: F.struct(F.abs(r["start"] - x["span"] + 3).alias("d"), r["start"].alias("start"), r["end"].alias("end"))))
        listed = lambda runs: F.array_join(F.transform(runs, lambda r: F.format_string("%d:%d", r["start"], r["end"])), ",")
        pick = lambda cond: listed(F.filter(x["runs"], cond))
        return F.struct(
            F.when(F.size(expected) > 0, "yes").when((size >= high) & (ambiguous == 0), "no").otherwise("not_fully_assessable").alias("state"), nearest["start"].alias("terminator_start"), nearest["end"].alias("terminator_end"),
            F.when(size >= high, "complete_window").when(seen >= low, "partial_window").otherwise("unavailable_window").alias("scan_status"), F.format_string("%d..%d", low, high).alias("requested_window"), ambiguous.alias("ambiguous"),
            listed(expected).alias("expected"), pick(lambda r: r["end"] < low).alias("internal"), pick(lambda r: r["start"] <= x["span"]).alias("body_overlapping"),
            pick(lambda r: (r["end"] >= low) & (r["start"] <= seen)).alias("window_overlapping"), F.size(x["runs"]).alias("n_runs"), F.coalesce(F.exists(x["runs"], lambda r: r["open"]), F.lit(False)).alias("right_censored"),
        )

    found = let(F.struct(F.upper("seq").alias("seq"), span.alias("span"), runs(F.upper("seq"), "T", T_RUN).alias("runs")), judged)
    return bodies.select("id", F.inline(F.array(found)))
