"""Geohash encode / decode as native Spark expressions.

No Python UDF is involved: the micro-degree offsets are divided into 30-bit
binary chunks in BIGINT, and every character is a shift and a mask of one
chunk, so the whole encode or decode is a few ``Project`` steps inside one
whole-stage codegen stage and needs no shuffle.

Encode is exact (rational bisection on the DECIMAL(10,6) input), so it
agrees with any exact geohash implementation at every precision, including
23 characters (115 bits, more than a double can hold).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessera.functions.columns import as_column as _col
from pyspark.sql.types import DecimalType

# The published geohash base-32 alphabet and the sentinel the
# reference writes for a missing coordinate.
ALPHABET = "0123456789bcdefghjkmnpqrstuvwxyz"
UNKNOWN = "unknown"
DEFAULT_PRECISION = 23

# conv() understands the plain base-32 digit set; translate() maps onto it.
_CONV_DIGITS = "0123456789abcdefghijklmnopqrstuv"
_VALID_CODE = "^[0-9b-hjkmnp-z]+$"

# Coordinates are handled in micro-degrees, the unit of DECIMAL(10,6).
_MICRO = 1_000_000
_LAT_SPAN = 180 * _MICRO
_LON_SPAN = 360 * _MICRO
# Decode handles this many characters (60 bits per axis pair in two BIGINTs);
# further characters change the cell centre by less than one double ulp.
_DECODE_CHARS = 24
_PART_CHARS = 12
# Encode works in chunks of 12 characters = 30 bits of each axis.
_CHARS_PER_CHUNK = 12
_CHUNK_BITS = 30


def to_coord(c) -> Column:
    """Coordinate as DECIMAL(10,6); malformed text, NaN and overflow -> NULL."""
    return _col(c).try_cast(DecimalType(10, 6))


def _ref(c) -> str:
    if not isinstance(c, str):
        raise TypeError("pass column names; build a Column first with select/alias")
    return "`" + c.replace("`", "``") + "`"


def _chunks_sql(offset: str, span: int, n_chunks: int) -> list[str]:
    """Successive 30-bit chunks of the binary fraction ``offset / span``.

    Long division 30 bits at a time: chunk = ``(rem << 30) div span`` and
    the remainder feeds the next chunk. ``rem < span < 2^29`` keeps every
    shifted value below 2^59, so all of it stays in BIGINT and is exact.
    """
    out, rem = [], offset
    for _ in range(n_chunks):
        shifted = f"shiftleft({rem}, {_CHUNK_BITS})"
        out.append(f"({shifted} div {span})")
        rem = f"({shifted} % {span})"
    return out


# Masks that move bit k of a 30-bit value to bit 2k (a Morton spread).
_SPREAD_STEPS = ((16, 0x0000FFFF0000FFFF), (8, 0x00FF00FF00FF00FF), (4, 0x0F0F0F0F0F0F0F0F),
                 (2, 0x3333333333333333), (1, 0x5555555555555555))


def _spread_sql(v: str) -> str:
    for shift, mask in _SPREAD_STEPS:
        v = f"((({v}) | shiftleft({v}, {shift})) & {mask})"
    return v


def _chars_sql(lat_chunks: list[str], lon_chunks: list[str], precision: int) -> str:
    """Characters from the axis chunks.

    Twelve characters use exactly 30 bits of each axis. Interleaving a lon
    chunk (odd bit positions, it leads) with its lat chunk gives the 60-bit
    value of those twelve characters; ``conv`` writes it in base 32 and
    ``translate`` maps the plain base-32 digits onto the geohash alphabet.
    """
    parts = []
    for la, lo in zip(lat_chunks, lon_chunks):
        value = f"(shiftleft({_spread_sql(lo)}, 1) | {_spread_sql(la)})"
        digits = f"lpad(conv(CAST({value} AS STRING), 10, 32), {_CHARS_PER_CHUNK}, '0')"
        parts.append(f"translate({digits}, '{_CONV_DIGITS.upper()}', '{ALPHABET}')")
    return f"substr(concat({', '.join(parts)}), 1, {precision})"


def _n_chunks(precision: int) -> int:
    return -(-precision // _CHARS_PER_CHUNK)


def _offsets_sql(lat: str, lon: str) -> tuple[str, str, str]:
    la = f"try_cast({lat} AS DECIMAL(10,6))"
    lo = f"try_cast({lon} AS DECIMAL(10,6))"
    valid = f"({la} BETWEEN -90 AND 90 AND {lo} BETWEEN -180 AND 180)"
    x = f"CASE WHEN {valid} THEN least(CAST({la} * {_MICRO} AS BIGINT) + {_LAT_SPAN // 2}, {_LAT_SPAN - 1}) END"
    y = f"CASE WHEN {valid} THEN least(CAST({lo} * {_MICRO} AS BIGINT) + {_LON_SPAN // 2}, {_LON_SPAN - 1}) END"
    return x, y, valid


def geohash_sql(lat: str, lon: str, precision: int = DEFAULT_PRECISION) -> str:
    """P5 as SQL text over two SQL expressions (see ``geohash``)."""
    if precision < 1:
        raise ValueError("precision must be >= 1")
    x, y, _ = _offsets_sql(lat, lon)
    n = _n_chunks(precision)
    # Offsets and chunks are bound as lambda variables, so each is computed
    # once per row; inlined, the bit spreads would copy them dozens of times.
    chunks = ", ".join([f"'la{k}', {e}" for k, e in enumerate(_chunks_sql("o.x", _LAT_SPAN, n))]
                       + [f"'lo{k}', {e}" for k, e in enumerate(_chunks_sql("o.y", _LON_SPAN, n))])
    chars = _chars_sql([f"c.la{k}" for k in range(n)], [f"c.lo{k}" for k in range(n)], precision)
    inner = f"transform(array(named_struct({chunks})), c -> {chars})[0]"
    return (f"transform(array(named_struct('x', {x}, 'y', {y})), "
            f"o -> CASE WHEN o.x IS NULL THEN '{UNKNOWN}' ELSE {inner} END)[0]")


def geohash(lat: str, lon: str, precision: int = DEFAULT_PRECISION) -> Column:
    """P5 as a Column over two column names: geohash text, or ``"unknown"``
    when a coordinate is NULL (F5), malformed or outside [-90, 90] x [-180, 180].
    The upper edges 90 and 180 are clamped one micro-degree inward (they
    would wrap to the lower edge).

    The expression is generated as SQL text and parsed once (building it
    node by node from Python costs far more than running it). Intermediate
    values are bound as lambda variables, which Spark evaluates without
    generated code; ``geo_encode`` stages them as projections instead and
    stays in whole-stage codegen, so prefer it for large inputs.
    """
    return F.expr(geohash_sql(_ref(lat), _ref(lon), precision))


def _others(df: DataFrame, replaced: list[str]) -> list[Column]:
    """Columns of ``df`` but for those about to be replaced (names as Spark resolves them)."""
    gone = {n.lower() for n in replaced}
    return [F.col(f"`{c}`") for c in df.columns if c.lower() not in gone]


def geo_encode(df: DataFrame, lat: str, long: str, precision: int = DEFAULT_PRECISION) -> DataFrame:
    """P4 + P5: replace ``lat``/``long`` by DECIMAL(10,6) and set ``GeoHash`` (a column of that name is replaced)."""
    if precision < 1:
        raise ValueError("precision must be >= 1")
    x, y, _ = _offsets_sql(_ref(lat), _ref(long))
    keep = [F.col(f"`{c}`") for c in df.columns]
    staged = df.select(*[to_coord(c).alias(c) if c in (lat, long) else F.col(f"`{c}`") for c in df.columns],
                       F.expr(x).alias("__gh_x"), F.expr(y).alias("__gh_y"))
    n = _n_chunks(precision)
    la_names, lo_names = [f"__gh_la{c}" for c in range(n)], [f"__gh_lo{c}" for c in range(n)]
    chunked = staged.select(*keep,
                            *[F.expr(e).alias(a) for e, a in zip(_chunks_sql("__gh_x", _LAT_SPAN, n), la_names)],
                            *[F.expr(e).alias(a) for e, a in zip(_chunks_sql("__gh_y", _LON_SPAN, n), lo_names)])
    code = f"coalesce({_chars_sql(la_names, lo_names, precision)}, '{UNKNOWN}')"
    return chunked.select(*_others(df, ["GeoHash"]), F.expr(code).alias("GeoHash"))


# Masks that move bit 2k of a 60-bit value to bit k (inverse Morton spread).
_COMPACT_STEPS = ((1, 0x3333333333333333), (2, 0x0F0F0F0F0F0F0F0F), (4, 0x00FF00FF00FF00FF),
                  (8, 0x0000FFFF0000FFFF), (16, 0x00000000FFFFFFFF))


def _compact_sql(v: str, odd: bool) -> str:
    """The 30 bits at odd (or even) positions of a 60-bit value, in order."""
    x = f"(shiftright({v}, 1) & {0x5555555555555555})" if odd else f"({v} & {0x5555555555555555})"
    for shift, mask in _COMPACT_STEPS:
        x = f"(({x} | shiftright({x}, {shift})) & {mask})"
    return x


def geohash_parts(code) -> dict[str, Column]:
    """Integer pieces of a code: 30+30 lat/lon bits from the first 12 characters,
    30+30 from the next 12, and the code length (NULL when the code is invalid)."""
    c = _col(code)
    valid = c.rlike(_VALID_CODE)
    digits = F.translate(F.rpad(c, _DECODE_CHARS, "0"), ALPHABET, _CONV_DIGITS)
    hi = F.conv(F.substr(digits, F.lit(1), F.lit(_PART_CHARS)), 32, 10).cast("bigint")
    lo = F.conv(F.substr(digits, F.lit(_PART_CHARS + 1), F.lit(_PART_CHARS)), 32, 10).cast("bigint")
    n = F.least(F.length(c), F.lit(_DECODE_CHARS))
    return {
        "hi": F.when(valid, hi),
        "lo": F.when(valid, lo),
        "n": F.when(valid, n),
    }


def _centre_sql(hi_bits: str, lo_bits: str, nbits: str, low: float, span: float) -> str:
    # lower cell corner from two exact 30-bit fractions, then half a cell
    two30, two60 = float(1 << 30), float(1 << 60)
    corner = f"(CAST({low!r} AS DOUBLE) + CAST({span!r} AS DOUBLE) * CAST({hi_bits} AS DOUBLE) / CAST({two30!r} AS DOUBLE))"
    corner = f"({corner} + CAST({span!r} AS DOUBLE) * CAST({lo_bits} AS DOUBLE) / CAST({two60!r} AS DOUBLE))"
    return f"({corner} + CAST({span / 2!r} AS DOUBLE) / CAST(shiftleft(CAST(1 AS BIGINT), {nbits}) AS DOUBLE))"


def geo_decode(df: DataFrame, code: str, exact: bool = False,
               lat_name: str = "Latitude", lon_name: str = "Longitude") -> DataFrame:
    """Set the cell centre of ``code`` as ``Latitude``/``Longitude`` (columns of these names are replaced).

    FLOAT like the reference by default, DOUBLE with ``exact=True``.
    ``"unknown"`` (F6), NULL (F5) and codes with letters outside the
    alphabet give NULLs.
    Per-row projection: no row index and no join, unlike the reference.
    """
    p = geohash_parts(code)
    tmp = ["__gh_hi", "__gh_lo", "__gh_n"]
    staged = df.select("*", p["hi"].alias(tmp[0]), p["lo"].alias(tmp[1]), p["n"].alias(tmp[2]))
    hi, lo, n = tmp
    lat_bits, lon_bits = f"(({n} * 5) div 2)", f"(({n} * 5 + 1) div 2)"
    lat = _centre_sql(f"({_compact_sql(hi, False)})", f"({_compact_sql(lo, False)})", lat_bits, -90.0, 180.0)
    lon = _centre_sql(f"({_compact_sql(hi, True)})", f"({_compact_sql(lo, True)})", lon_bits, -180.0, 360.0)
    kind = "DOUBLE" if exact else "FLOAT"
    return staged.select(*_others(df, [lat_name, lon_name]),
                         F.expr(f"CAST({lat} AS {kind})").alias(lat_name),
                         F.expr(f"CAST({lon} AS {kind})").alias(lon_name))
