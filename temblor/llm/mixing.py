"""Mixing sources to target weights by Pfair scheduling.

Each source's documents form blocks of ``block_chars`` characters. With target weight w, a source's
k-th block (from 1) may start at slot floor((k-1)/w) and must be placed before slot ceil(k/w);
earliest deadline first then gives every slot to one source, and after any number of slots t a
source has got more than w t - 1 and less than w t + 1 blocks. Ties of deadlines go to the source
whose next window opens first, then by name, which keeps all deadlines for one slot at a time.

Weights are whole numbers of blocks in a period, so lags are zero at the end of a period and the
schedule repeats: one period of at most ``period`` slots is scheduled, once, and a block's slot
follows from its number by arithmetic. When a source runs out, a phase ends, and the sources left
share the next phase in proportion to their weights. There are as many phases as sources at most,
and documents never pass through the driver: only the totals per source do.

Which document is in which block comes from running sums of characters in a random but fixed order
of each source's documents; a large source is split into ``part_rows`` sized parts by a hash, whose
totals are summed first, so no source has to be ordered in one task.
"""

from __future__ import annotations

import heapq
import math
from dataclasses import dataclass
from fractions import Fraction

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from temblor.llm.frames import OWN, numbered, written


#: Parts a weight may be a fraction of. A period is scheduled on the driver.
MOST_SLOTS = 1_000_000


@dataclass(frozen=True)
class Mix:
    """``weights`` by source; other sources share by their number of characters to ``power``."""

    weights: dict[str | None, float | Fraction] | None = None
    power: float = 0.5
    block_chars: int = 1 << 16
    period: int = 1000
    part_rows: int = 2_000


def exact(weight: float | Fraction) -> Fraction:
    """The simplest fraction that a weight stands for: 0.0001 is 1/10000 and 0.3333333333333333 a third."""
    found = Fraction(weight).limit_denominator(MOST_SLOTS)
    if abs(found - Fraction(weight)) > abs(Fraction(weight)) * Fraction(1, 10**12):
        raise ValueError(f"weight {weight!r} is no fraction below {MOST_SLOTS} parts; give it as a Fraction or round it")
    return found


def whole_weights(weights: dict, period: int) -> dict:
    """Whole numbers that sum to ``max(period, sources)``, at least 1 each, by largest remainders."""
    period = max(period, len(weights))
    total = math.fsum(weights.values())
    spare = period - len(weights)
    parts = {s: w / total * spare for s, w in weights.items()}
    out = {s: 1 + int(e) for s, e in parts.items()}
    rest = period - sum(out.values())
    for s in sorted(parts, key=lambda s: (int(parts[s]) - parts[s], _name(s)))[:rest]:
        out[s] += 1
    return out


def _name(source: str | None) -> tuple[bool, str]:
    return source is None, source or ""


def schedule(weights: dict) -> list:
    """The source of each slot of one period, by earliest deadline first.

    ``weights`` are whole numbers; the period is their sum, so in it every source gets as many
    slots as its weight says, each between its release and its deadline.
    """
    period = sum(weights.values())
    share = {s: Fraction(w, period) for s, w in weights.items() if w > 0}
    names = sorted(share, key=_name)
    waiting = [(0, i, 1) for i in range(len(names))]  # release, source, number of the block
    ready: list[tuple[int, int, int, int]] = []  # deadline, next release, source, number
    out = []
    for slot in range(period):
        while waiting and waiting[0][0] <= slot:
            _, i, k = heapq.heappop(waiting)
            deadline = math.ceil(k / share[names[i]])
            heapq.heappush(ready, (deadline, math.floor(k / share[names[i]]), i, k))
        deadline, release, i, k = heapq.heappop(ready)
        if deadline <= slot:
            raise AssertionError(f"slot {slot}: the block of {names[i]!r} was due before {deadline}")
        out.append(names[i])
        if k < weights[names[i]]:
            heapq.heappush(waiting, (release, i, k + 1))
    return out


@dataclass(frozen=True)
class Phase:
    """Slots from ``start`` on, while all of ``weights`` have blocks: source to weight, and the
    number of blocks each had already placed."""

    start: int
    weights: dict
    placed: dict


def phases(blocks: dict, weights: dict) -> list[Phase]:
    """Phases that place every block, the sources that are left sharing by their whole ``weights``. A
    phase ends at the first period that some source cannot fill whole, except the last periods of a
    source, which others simply skip."""
    left, placed, start, out = dict(blocks), {s: 0 for s in blocks}, 0, []
    while open_sources := [s for s in left if left[s] > 0]:
        common = math.gcd(*(weights[s] for s in open_sources))
        own = {s: weights[s] // common for s in open_sources}
        out.append(Phase(start, own, dict(placed)))
        periods = min(math.ceil(left[s] / own[s]) for s in open_sources)
        for s in open_sources:
            done = min(left[s], periods * own[s])
            left[s] -= done
            placed[s] += done
        start += periods * sum(own.values())
    return out


def targets(chars: dict, mix: Mix) -> dict:
    """Whole weights per source. Given ones keep their exact proportions and, if sources without a
    weight take part, their sum; those share what is left to one, a thousandth if nothing is, by
    characters to ``power``, in at least ``period`` parts."""
    given = {s: exact(w) for s, w in (mix.weights or {}).items() if s in chars and w > 0}
    rest = {s: float(max(n, 1)) ** mix.power for s, n in chars.items() if s not in given}
    if not given:
        return whole_weights(rest, mix.period)
    parts = math.lcm(*(w.denominator for w in given.values()))
    spare = max(Fraction(0), 1 - sum(given.values())) or Fraction(1, 1000)
    if rest:
        # so many parts of a whole that the rest has at least ``period`` of them
        parts = math.lcm(parts, spare.denominator)
        parts *= math.ceil(max(mix.period, len(rest)) / (spare * parts))
    weights = {s: int(w * parts) for s, w in given.items()}
    if rest:
        weights |= whole_weights(rest, int(spare * parts))
    common = math.gcd(*weights.values())
    weights = {s: w // common for s, w in weights.items()}
    if sum(weights.values()) > MOST_SLOTS * len(weights):
        raise ValueError(f"the weights need a period of {sum(weights.values())} slots; round them")
    return weights


def keyed(docs: DataFrame) -> DataFrame:
    """``docs`` with what placing needs: size in characters, place in the source's order, source key.

    ``docs`` is read from files. Documents of a source follow each other in the order of a hash of
    their id, text and number in the table, so equal rows spread over the order like others. A null
    source is a source; a null or empty text counts one character, so every document has a place.
    """
    at = f"{OWN}at"
    size = F.greatest(F.coalesce(F.char_length("text"), F.lit(0)), F.lit(1)).cast("long")
    source = F.col("source").cast("string")
    own = numbered(docs, at).withColumns(
        {
            f"{OWN}size": size,
            f"{OWN}order": F.xxhash64("doc_id", "text", at),
            f"{OWN}source": F.when(source.isNull(), F.lit("n")).otherwise(F.concat(F.lit("s"), source)),
        }
    )
    return own.drop(at)


def _source(key: str) -> str | None:
    return None if key == "n" else key[1:]


def placed(rows: DataFrame, mix: Mix = Mix()) -> DataFrame:
    """``rows`` of ``keyed`` with their block, offset in it and slot, under this package's prefix.

    Sorting by slot, then offset, then order gives the mixture. Every row stays. The number of
    sources bounds what the driver holds: totals, phases and one period of slots for each phase.
    """
    spark = rows.sparkSession
    source, size, order, part = f"{OWN}source", f"{OWN}size", f"{OWN}order", f"{OWN}part"
    block, offset = F.col(f"{OWN}block"), f"{OWN}offset"
    slim = written(rows.select(source, size, order), "mix-sizes")
    totals = {_source(r[0]): (r[1], r[2]) for r in slim.groupBy(source).agg(F.sum(size), F.count(F.lit(1))).collect()}
    if not totals:
        return rows.withColumns({f"{OWN}{c}": F.lit(None).cast("long") for c in ("block", "offset", "slot")})
    chars = {s: c for s, (c, _) in totals.items()}
    blocks = {s: -(-c // mix.block_chars) for s, c in chars.items()}
    plan = phases(blocks, targets(chars, mix))
    key = lambda s: "n" if s is None else f"s{s}"

    # A part is a range of the order column, so the parts of a source in turn are the source.
    parts = spark.createDataFrame([(key(s), -(-n // mix.part_rows)) for s, (_, n) in totals.items()], "s string, parts long")
    number = F.floor((F.col(order).cast("double") + F.lit(2.0**63)) / F.lit(2.0**64) * F.col("parts")).cast("long")
    number = F.least(number, F.col("parts") - 1)

    def in_parts(df: DataFrame) -> DataFrame:
        return df.join(F.broadcast(parts), df[source] == parts["s"]).withColumn(part, number).drop("s", "parts")

    sums = in_parts(slim).groupBy(source, part).agg(F.sum(size).alias("sum"))
    before = Window.partitionBy(source).orderBy(part).rowsBetween(Window.unboundedPreceding, -1)
    starts = written(
        sums.select(F.col(source).alias("s"), F.col(part).alias("p"), F.coalesce(F.sum("sum").over(before), F.lit(0)).alias("before")), "mix-parts"
    )
    within = Window.partitionBy(source, part).orderBy(order, size).rowsBetween(Window.unboundedPreceding, -1)
    run = in_parts(rows).withColumn(f"{OWN}sum", F.coalesce(F.sum(size).over(within), F.lit(0)))
    run = run.join(starts, (run[source] == starts["s"]) & (run[part] == starts["p"])).drop("s", "p")
    at = F.col("before") + F.col(f"{OWN}sum")
    run = run.withColumns({f"{OWN}block": F.floor(at / mix.block_chars).cast("long"), offset: at % mix.block_chars})

    # A block's slot by arithmetic: its phase, its number there, its period and place in it.
    slots = []
    for i, phase in enumerate(plan):
        places: dict = {}
        for slot, s in enumerate(schedule(phase.weights)):
            places.setdefault(s, []).append(slot)
        for s, own in places.items():
            last = plan[i + 1].placed[s] if i + 1 < len(plan) else blocks[s]
            if last > phase.placed[s]:
                slots.append((key(s), phase.placed[s], last, phase.start, sum(phase.weights.values()), own))
    table = spark.createDataFrame(slots, "s string, first long, last long, start long, period long, places array<long>")
    run = run.join(F.broadcast(table), (run[source] == table["s"]) & (block >= F.col("first")) & (block < F.col("last")))
    k, w = block - F.col("first"), F.size("places")
    slot = F.col("start") + F.floor(k / w) * F.col("period") + F.get("places", (k % w).cast("int"))
    return run.withColumn(f"{OWN}slot", slot.cast("long")).select(*rows.columns, f"{OWN}block", offset, f"{OWN}slot")


def in_order(docs: DataFrame, mix: Mix = Mix()) -> DataFrame:
    """All rows of ``docs``, read from files, with their columns, sorted into the mixture by ranges of slots."""
    return placed(keyed(docs), mix).orderBy(f"{OWN}slot", f"{OWN}offset", f"{OWN}order").select(*docs.columns)
