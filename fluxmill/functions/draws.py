"""Seeded random draws that depend on (seed, row key, draw number) only.

rand(seed) depends on how rows fall into partitions, so a re-run after an executor loss or with
another layout would give other data. These draws are plain integer arithmetic on the key: the same
row anywhere, and the same in any SQL engine.
"""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F

# Largest prime below 2^31 for which x -> x^3 is one-to-one (the prime is 2 modulo 3).
PRIME = 2_147_483_579
LOW_BITS = 31
LOW_MASK = 2**LOW_BITS - 1
HIGH_FACTOR = 69_621
ROUND_FACTOR = 16_807
STEP = 1.0 / PRIME


def draw_constants(seed: int, number: int) -> tuple[int, int, int]:
    """Factor and offsets of one draw; each product stays below 2^63."""
    factor = 48_271 + 2 * number
    first = (seed * 7_919 + number * 104_729 + 1) % PRIME
    second = (seed * 15_485_863 + number * 32_452_843 + 2) % PRIME
    return factor, first, second


def _cubed(x: Column) -> Column:
    return x * (x * x % PRIME) % PRIME


def uniform(key: Column, seed: int, number: int) -> Column:
    """A draw in the open interval (0, 1): two rounds of an affine step and a cube modulo the prime."""
    factor, first, second = draw_constants(seed, number)
    low, high = key.bitwiseAND(LOW_MASK), F.shiftright(key, LOW_BITS) % PRIME
    start = (low * factor + high * HIGH_FACTOR + first) % PRIME
    return (_cubed((_cubed(start) * ROUND_FACTOR + second) % PRIME) + F.lit(0.5)) * F.lit(STEP)


def uniform_int(u: Column, low: int, high: int) -> Column:
    """An int from low to high, both included."""
    return (F.floor(u * F.lit(float(high - low + 1))) + F.lit(low)).cast("int")


def exponential(u: Column, scale: float) -> Column:
    return F.lit(-scale) * F.ln(u)


def normal_pair(u1: Column, u2: Column) -> tuple[Column, Column]:
    """Two independent standard normal draws from two uniform ones (Box-Muller)."""
    radius, angle = F.sqrt(F.lit(-2.0) * F.ln(u1)), F.lit(2.0 * math.pi) * u2
    return radius * F.cos(angle), radius * F.sin(angle)


def clipped(value: Column, low: float, high: float) -> Column:
    return F.least(F.greatest(value, F.lit(low)), F.lit(high))


def cumulative_poisson(mean: float) -> list[float]:
    """P(X <= k) for k = 0, 1, ... until the tail is below the finest draw."""
    term = math.exp(-mean)
    total, k, table = term, 0, [term]
    while 1.0 - total > STEP:
        k += 1
        term *= mean / k
        total += term
        table.append(total)
    return table


def _first_reached(u: Column, edges: list[float], results: list, last) -> Column:
    """Result of the first edge the draw lies below."""
    chain = F.when(u < edges[0], results[0])
    for edge, result in zip(edges[1:], results[1:]):
        chain = chain.when(u < edge, result)
    return chain.otherwise(last)


def poisson(u: Column, mean: float) -> Column:
    table = cumulative_poisson(mean)
    return _first_reached(u, table, list(range(len(table))), len(table)).cast("int")


def cumulative_weights(weights: list[float]) -> list[float]:
    """Running sums without the last one, which is 1."""
    return [round(sum(weights[: i + 1]), 10) for i in range(len(weights) - 1)]


def weighted_choice(u: Column, values: list[str], weights: list[float]) -> Column:
    return _first_reached(u, cumulative_weights(weights), values[:-1], values[-1])
