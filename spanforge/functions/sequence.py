"""Nucleotide functions as column expressions: no Python runs on the executors."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Complement of the 15 letters, and the bases each letter stands for.
LETTERS, COMPLEMENTS = "ACGTRYSWKMBDHVN", "TGCAYRSWMKVHDBN"
BASES = {"A": "A", "C": "C", "G": "G", "T": "T", "R": "AG", "Y": "CT", "S": "CG", "W": "AT", "K": "GT", "M": "AC", "B": "CGT", "D": "AGT", "H": "ACT", "V": "ACG", "N": "ACGT"}


def let(value: Column, body) -> Column:
    """body(value) with value computed once: a lambda variable is not expanded again inside the lambdas of body."""
    return F.transform(F.array(value), body)[0]


def reverse_complement(seq: Column) -> Column:
    return F.reverse(F.translate(F.upper(seq), LETTERS, COMPLEMENTS))


def count_letters(seq: Column, letters: str) -> Column:
    return F.length(seq) - F.length(F.translate(seq, letters, ""))


def upstream(seq: Column, strand: Column, tss: Column, size: Column) -> Column:
    """The window of up to ``size`` bases before position ``tss`` in the direction of ``strand``, never padded and never
    holding tss: status (fixed vocabulary), seq, start1, end1, truncated, first (position of its first base relative to
    +1), n_count and ambiguous. A tss outside the sequence has an empty window, as has one with no base before it."""

    def cut(given: Column) -> Column:
        text, at, k = given["seq"], given["tss"], given["size"]
        total = F.length(text)
        plus = strand == "+"
        start = F.when(plus, F.greatest(F.lit(1), at - k)).otherwise(at + 1)
        end = F.when(plus, at - 1).otherwise(F.least(total, at + k))
        inside = (at >= 1) & (at <= total)
        whole = F.when(inside & (end >= start), F.substring(text, start, end - start + 1)).otherwise("")
        return let(F.struct(F.when(plus, F.upper(whole)).otherwise(reverse_complement(whole)).alias("seq"), start.alias("start"), end.alias("end"), inside.alias("inside"), k.alias("size")), told)

    def told(x: Column) -> Column:
        n = F.length(x["seq"])
        some = n > 0
        status = F.when(~x["inside"], "boundary_outside_reference").when(~some, "no_upstream_sequence_at_reference_edge").when(n < x["size"], "truncated_reference_edge").otherwise("complete")
        return F.struct(
            status.alias("status"), x["seq"].alias("seq"), F.when(some, x["start"]).alias("start1"), F.when(some, x["end"]).alias("end1"), (n < x["size"]).alias("truncated"),
            F.when(some, -n).alias("first"), count_letters(x["seq"], "N").alias("n_count"), (n - count_letters(x["seq"], "ACGT")).alias("ambiguous"),
        )

    return let(F.struct(seq.alias("seq"), tss.alias("tss"), size.alias("size")), cut)


def upstream_span(strand: Column, tss: Column, size: Column, total: Column) -> Column:
    """status, start1 and end1 of the window that `upstream` cuts from a sequence of ``total`` bases."""
    plus = strand == "+"
    start, end = F.when(plus, F.greatest(F.lit(1), tss - size)).otherwise(tss + 1), F.when(plus, tss - 1).otherwise(F.least(total, tss + size))
    inside, some = (tss >= 1) & (tss <= total), (tss >= 1) & (tss <= total) & (end >= start)
    status = F.when(~inside, "boundary_outside_reference").when(~some, "no_upstream_sequence_at_reference_edge").when(end - start + 1 < size, "truncated_reference_edge").otherwise("complete")
    return F.struct(status.alias("status"), F.when(some, start).alias("start1"), F.when(some, end).alias("end1"))


def oriented(seq: Column, strand: Column, start: Column, end: Column) -> Column:
    """Positions start..end in the direction of the strand, clipped to the sequence."""
    low, high = F.greatest(F.lit(1), start), F.least(F.length(seq), end)
    part = F.substring(seq, low, F.greatest(F.lit(0), high - low + 1))
    return F.when(strand == "+", part).otherwise(reverse_complement(part))


def related_windows(seq: Column, strand: Column, tss: Column, start: Column, end: Column, flank: int = 60) -> Column:
    """Of a body at start..end: body, its flanked window with that window's low and high, the base at +1, and the
    context that runs from +1 to ``flank`` bases past the body, with span, the body's bases from +1 on."""
    plus = strand == "+"
    return F.struct(
        oriented(seq, strand, start, end).alias("body"), oriented(seq, strand, start - flank, end + flank).alias("flanked"), F.greatest(F.lit(1), start - flank).alias("low"), F.least(F.length(seq), end + flank).alias("high"),
        oriented(seq, strand, tss, tss).alias("plus1"), F.when(plus, oriented(seq, strand, tss, end + flank)).otherwise(oriented(seq, strand, start - flank, tss)).alias("context"),
        F.when(plus, end - tss + 1).otherwise(tss - start + 1).alias("span"),
    )


def mismatches(word: Column, motif: str) -> Column:
    """Positions of a word whose base the motif's letter does not stand for; an ambiguous base always differs."""
    return sum((F.when(F.instr(F.lit(BASES[letter]), F.substring(word, k, 1)) > 0, 0).otherwise(1) for k, letter in enumerate(motif, 1)), F.lit(0))


def motif_hits(seq: Column, first: Column, motif: str, low: int, high: int, most: int) -> Column:
    """Array of (start, mismatches) of the motif; ``first`` is the position of the sequence's first base relative to +1
    (-n for an upstream window of n bases); starts in low..high with at most ``most`` mismatches."""
    size = len(motif)

    def found(given: Column) -> Column:
        text, begin = given["seq"], given["first"]
        from_, upto = F.greatest(F.lit(low), begin), F.least(F.lit(high), begin + F.length(text) - size)
        starts = F.when(upto >= from_, F.sequence(from_, upto)).otherwise(F.array().cast("array<int>"))
        count = lambda p: let(F.substring(text, p - begin + 1, F.lit(size)), lambda word: mismatches(word, motif))
        return F.filter(F.transform(starts, lambda p: F.struct(p.alias("start"), count(p).alias("mm"))), lambda h: h["mm"] <= most)

    return let(F.struct(seq.alias("seq"), first.alias("first")), found)


def runs(seq: Column, base: str, least: int) -> Column:
    """Array of (start, end, open) of maximal runs of a base, in order; open: the run reaches the sequence's end."""
    # Parts alternate: outside, run, outside, ...; a running length gives each run's place.
    empty = F.struct(F.lit(0).alias("at"), F.array().cast("array<struct<start:int,end:int,open:boolean>>").alias("runs"))

    def found(text: Column) -> Column:
        def step(acc: Column, part: Column) -> Column:
            after = (acc["at"] + F.length(part["text"])).cast("int")
            run = F.struct((acc["at"] + 1).cast("int").alias("start"), after.alias("end"), (after == F.length(text)).alias("open"))
            return F.struct(after.alias("at"), F.when(part["odd"], F.concat(acc["runs"], F.array(run))).otherwise(acc["runs"]).alias("runs"))

        parts = F.split(F.regexp_replace(text, f"{base}{{{least},}}", "<$0>"), "[<>]")
        numbered = F.transform(parts, lambda x, i: F.struct(x.alias("text"), (i % 2 == 1).alias("odd")))
        return F.aggregate(numbered, empty, step, lambda acc: acc["runs"])

    return let(seq, found)


def position_map(query: Column, subject: Column, at: Column) -> Column:
    """Subject position aligned to query residue ``at`` of two gapped strings (both from 1); null where it is deleted or absent."""

    def found(pair: Column) -> Column:
        # The column of the residue: the part that holds it is halved until it is one letter, so all parts have twice the text's letters.
        count = lambda text: F.length(F.translate(text, "-", ""))
        start = F.struct(pair["q"].alias("part"), pair["at"].cast("int").alias("need"), F.lit(0).alias("before"))

        def halve(acc: Column, _: Column) -> Column:
            return let(F.struct(acc["part"].alias("part"), F.ceil(F.length(acc["part"]) / 2).cast("int").alias("n")), lambda x: let(F.struct(x["part"].alias("part"), x["n"].alias("n"), F.substring(x["part"], F.lit(1), x["n"]).alias("half")), lambda y: let(F.struct(y["part"].alias("part"), y["n"].alias("n"), y["half"].alias("half"), count(y["half"]).alias("k")), lambda z: F.when(z["k"] >= acc["need"], F.struct(z["half"].alias("part"), acc["need"].alias("need"), acc["before"].alias("before"))).otherwise(F.struct(F.substring(z["part"], z["n"] + 1, F.length(z["part"])).alias("part"), (acc["need"] - z["k"]).alias("need"), (acc["before"] + z["n"]).alias("before"))))))

        turns = F.sequence(F.lit(0), F.ceil(F.log2(F.greatest(F.length(pair["q"]), F.lit(1)))).cast("int"))
        column = F.aggregate(turns, start, halve, lambda acc: F.when((acc["need"] == 1) & (F.length(acc["part"]) == 1) & (acc["part"] != "-"), acc["before"] + 1))
        there = let(column, lambda c: let(F.substring(pair["s"], F.lit(1), c), lambda text: F.when((F.length(text) == c) & ~F.endswith(text, F.lit("-")), count(text))))
        return F.when(pair["at"] > 0, there)

    return let(F.struct(query.alias("q"), subject.alias("s"), at.alias("at")), found)


def longest_gap(aligned: Column) -> Column:
    """Longest run of '-' between the first and the last residue."""
    inner = F.regexp_replace(aligned, "^-+|-+$", "")
    return F.array_max(F.transform(F.split(inner, "[^-]"), lambda x: F.length(x)))
