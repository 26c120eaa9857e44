"""Lines joined end to end inside one row: a list of parts becomes the list of the lines they make.

The walk along the chains is the pointer jumping of ``operators/chains.py`` over positions of a list.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

NUMBERS = 2**16  # the last bits of a key hold the number of an end: a list has half as many lines at most


def _let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of a value that is worked out once."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def _at(items: Column, place: Column | int) -> Column:
    return F.get(items, F.lit(place) if isinstance(place, int) else place)


def _other_end(end: Column) -> Column:
    return end.bitwiseXOR(F.lit(1))


def one_line(parts: Column, ring: Column) -> Column:
    """The parts of a chain in order as one list of points, from its smaller end."""
    # A circle is turned so that it starts at its smallest joint.
    starts = F.transform(parts, lambda p: _at(p, 0))
    first = F.array_position(starts, F.array_min(starts)).cast("int")
    turned = F.concat(F.slice(parts, first, F.size(parts)), F.slice(parts, F.lit(1), first - 1))

    def line(parts: Column) -> Column:
        rest = F.flatten(F.transform(parts, lambda p: F.slice(p, F.lit(2), F.size(p))))
        return F.concat(F.slice(_at(parts, 0), 1, 1), rest)

    return _let(line(F.when(ring, turned).otherwise(parts)), lambda found: F.least(found, F.reverse(found)))


def _runs(items: Column, same: Callable[[Column, Column], Column], made: Callable[[Column, Column], Column]) -> Column:
    """``made`` of the place and length of every run of neighbours that are the ``same``."""
    places = F.sequence(F.lit(0), F.size(items) - 1)
    heads = F.filter(places, lambda i: (i == 0) | ~same(_at(items, i - 1), _at(items, i)))

    def of_heads(found: Column) -> Column:
        after = F.concat(F.slice(found, F.lit(2), F.size(found)), F.array(F.size(items)))
        return F.zip_with(found, after, lambda a, b: made(a, b - a))

    return _let(heads, of_heads)


def _line(copies: Column, part: Column) -> Column:
    return F.struct(copies.cast("bigint").alias("copies"), part.alias("part"))


def with_codes(part: Column) -> Column:
    """A part as ``joined`` and ``counted`` take it, with the hashes of its ends: equal ends have equal
    ones. A zero has no sign, as in the keys of a grouping."""
    first, last = F.xxhash64(_at(part, 0)), F.xxhash64(F.try_element_at(part, F.lit(-1)))
    zeros = F.exists(part, lambda p: (p["x"] == 0) | (p["y"] == 0))
    plain = F.transform(part, lambda p: F.when(
        p.isNotNull(), F.struct((p["x"] + F.lit(0.0)).alias("x"), (p["y"] + F.lit(0.0)).alias("y"))))
    return F.struct(first.alias("first"), last.alias("last"), F.when(zeros, plain).otherwise(part).alias("part"))


def _parts(parts: Column, made: Callable[[Column, Column], Column]) -> Column:
    """``made`` of the different parts of a list sorted by its codes, and of how often each is in it."""
    def same(a: Column, b: Column) -> Column:
        return (a["first"] == b["first"]) & (a["last"] == b["last"]) & a["part"].eqNullSafe(b["part"])

    return _runs(parts, same, lambda i, n: made(_at(parts, i), n))


def counted(parts: Column) -> Column:
    """``(copies, part)`` of the different parts of a sorted list."""
    return _parts(parts, lambda one, n: _line(n, one["part"]))


def joined(parts: Column) -> Column:
    """``(copies, part)`` of the lines that a sorted list of parts makes. A part has two points or
    more and is drawn from its smaller end."""

    def lines(one: Column, n: Column) -> Column:
        return F.struct(n.cast("bigint").alias("copies"), one["part"].alias("part"), one["first"], one["last"])

    alone = F.transform(parts, lambda one: _line(F.lit(1), one["part"]))
    return F.when(F.size(parts) == 1, alone).otherwise(_let(_parts(parts, lines), _joined))


def _joined(lines: Column) -> Column:
    """An end of a line is the number ``2 * line + side``, as in ``tiles._chains``."""

    def point(end: Column) -> Column:
        part = _at(lines, F.shiftright(end, 1))["part"]
        return F.when(end % 2 == 0, _at(part, 0)).otherwise(F.element_at(part, -1))

    def key(code: Column, end: Column) -> Column:
        return (code.bitwiseAND(F.lit(-NUMBERS))).bitwiseOR(end.cast("bigint"))

    def number(key: Column) -> Column:
        return key.bitwiseAND(F.lit(NUMBERS - 1)).cast("int")

    def touching(keys: Column) -> Column:
        """The sorted keys, and the places of those whose code the next one has as well."""
        places = F.filter(
            F.sequence(F.lit(0), F.size(keys) - 2),
            lambda k: F.shiftright(_at(keys, k).bitwiseXOR(_at(keys, k + 1)), NUMBERS.bit_length() - 1) == 0,
        )
        return F.struct(keys.alias("keys"), places.alias("places"))

    def by_codes() -> Column:
        first = F.transform(lines, lambda line, i: key(line["first"], i * 2))
        last = F.transform(lines, lambda line, i: key(line["last"], i * 2 + 1))
        return _let(F.sort_array(F.concat(first, last)), touching)

    def by_points() -> Column:
        """The same with the rank of its point for the code of an end: for points whose hashes meet."""
        numbers = F.sequence(F.lit(0), F.size(lines) * 2 - 1)
        every = F.transform(numbers, point)
        ranked = lambda every: F.sort_array(
            F.transform(numbers, lambda i: key(F.array_position(every, _at(every, i)) * NUMBERS, i))
        )
        return _let(_let(every, ranked), touching)

    def is_exact(found: Column) -> Column:
        same = lambda k: point(number(_at(found["keys"], k))).eqNullSafe(point(number(_at(found["keys"], k + 1))))
        return F.forall(found["places"], same)

    def of_touching(found: Column) -> Column:
        exact = F.when(is_exact(found), found).otherwise(by_points())
        joints = _let(exact, joints_of)
        alike = F.transform(lines, lambda line: _line(line["copies"], line["part"]))
        several = _let(joints, lambda met: F.when(F.size(met) == 0, alike).otherwise(_chained(lines, met)))
        return F.when(F.size(found["places"]) == 0, alike).otherwise(several)

    def joints_of(found: Column) -> Column:
        places, keys = found["places"], found["keys"]
        # A run of two: neither the place before nor the one behind is in the list.
        two = F.filter(
            places,
            lambda k, i: (F.coalesce(_at(places, i - 1), F.lit(-2)) != k - 1) & (F.coalesce(_at(places, i + 1), F.lit(-2)) != k + 1),
        )
        joints = F.transform(two, lambda k: F.struct(number(_at(keys, k)).alias("a"), number(_at(keys, k + 1)).alias("b")))
        # Two ends of one line make it closed: it touches no other.
        return F.filter(joints, lambda j: F.shiftright(j["a"], 1) != F.shiftright(j["b"], 1))

    return F.when(F.size(lines) == 1, F.transform(lines, lambda line: _line(line["copies"], line["part"]))).otherwise(
        _let(by_codes(), of_touching)
    )


def _chained(lines: Column, joints: Column) -> Column:
    """``joints`` are the pairs of ends that touch each other and no third one."""
    a, b = F.transform(joints, lambda j: j["a"]), F.transform(joints, lambda j: j["b"])
    return _let(
        F.struct(F.concat(a, b).alias("end"), F.concat(b, a).alias("other")),
        lambda met: _let(
            F.sort_array(F.array_distinct(F.transform(met["end"], lambda end: F.shiftright(end, 1)))),
            lambda linked: F.concat(
                F.transform(
                    F.array_except(F.sequence(F.lit(0), F.size(lines) - 1), linked),
                    lambda i: _line(_at(lines, i)["copies"], _at(lines, i)["part"]),
                ),
                _walked(lines, linked, met),
            ),
        ),
    )


def _walked(lines: Column, linked: Column, met: Column) -> Column:
    """The chains of the linked lines. From here on an end is ``2 * place among the linked + side``.

    Standing for walking into the line at that end, it comes from the other end of the line it touches.
    """
    # A chain has no more joints than there are.
    rounds = F.array_repeat(F.lit(0), F.ceil(F.log2(F.size(met["end"]) / 2)).cast("int"))

    def before(end: Column) -> Column:
        """The end that the walk into an end entered before, or null."""
        given = _at(linked, F.shiftright(end, 1)) * 2 + end % 2
        found = _at(met["other"], F.array_position(met["end"], given).cast("int") - 1)
        return _let(
            found, lambda other: (F.array_position(linked, F.shiftright(other, 1)).cast("int") - 1) * 2 + 1 - other % 2
        )

    def state(root: Column, at: Column, low: Column) -> Column:
        return F.struct(root.alias("root"), at.alias("at"), low.alias("low"))

    def start(end: Column) -> Column:
        def of(prev: Column) -> Column:
            first = state(end, F.lit(0), end)
            return F.when(prev.isNull(), first).otherwise(state(prev, F.lit(1), F.least(end, prev)))

        return _let(before(end), of)

    def jumped(walks: Column) -> Column:
        def onward(now: Column, walk: Column) -> Column:
            there = lambda t: state(t["root"], walk["at"] + t["at"], F.least(walk["low"], t["low"]))
            return F.when(walk["at"] == 0, walk).otherwise(_let(_at(now, walk["root"]), there))

        return F.aggregate(rounds, walks, lambda now, _: F.transform(now, lambda walk: onward(now, walk)))

    def is_ring(walks: Column, walk: Column) -> Column:
        return _at(walks, walk["root"])["at"] > 0

    def opened(walks: Column) -> Column:
        """Every circle cut open before its smallest end."""

        def cut(walk: Column, i: Column) -> Column:
            own = F.when(walk["low"] == i, state(i, F.lit(0), i)).otherwise(state(before(i), F.lit(1), walk["low"]))
            return F.when(is_ring(walks, walk), own).otherwise(walk)

        return jumped(F.transform(walks, cut))

    def placed(walks: Column, rings: Column, ranks: Column) -> Column:
        # Both walks of a line meet the same chain from its two ends: the one from the smaller counts.
        def place(end: Column) -> Column:
            rank = _at(ranks, end)
            ring = rings & is_ring(walks, _at(walks, end))
            return F.struct(rank["root"].alias("root"), rank["at"].alias("at"), end.alias("end"), ring.alias("ring"))

        return F.transform(linked, lambda _, i: F.least(place(i * 2), place(i * 2 + 1)))

    def line_of(step: Column) -> Column:
        return _at(lines, _at(linked, F.shiftright(step["end"], 1)))

    def directed(step: Column) -> Column:
        part = line_of(step)["part"]
        return F.when(step["end"] % 2 == 1, F.reverse(part)).otherwise(part)

    def chain(steps: Column) -> Column:
        copies = F.aggregate(steps, F.lit(0).cast("bigint"), lambda n, step: n + line_of(step)["copies"])
        parts = F.transform(steps, directed)
        return _let(parts, lambda parts: _line(copies, one_line(parts, _at(steps, 0)["ring"])))

    def of_steps(steps: Column) -> Column:
        return _runs(
            steps, lambda a, b: a["root"] == b["root"], lambda i, n: _let(F.slice(steps, i + 1, n), chain)
        )

    def of_walks(walks: Column) -> Column:
        rings = F.exists(walks, lambda walk: is_ring(walks, walk))

        def of_rings(rings: Column) -> Column:
            ranks = F.when(rings, opened(walks)).otherwise(walks)
            return _let(ranks, lambda ranks: _let(F.sort_array(placed(walks, rings, ranks)), of_steps))

        return _let(rings, of_rings)

    starts = F.transform(F.sequence(F.lit(0), F.size(linked) * 2 - 1), start)
    return _let(jumped(starts), of_walks)
