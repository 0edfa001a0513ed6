"""Edit distance for typo-tolerant matching."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Below this length candidates share a text with up to two letters deleted; above it they
# share one of five pieces, so the number of keys does not grow with the square of the length.
SHORT = 24
PIECES = 5


def _let(value: Column, body) -> Column:
    """body(value), with value worked out once."""
    return F.transform(F.array(value), body)[0]


def _core(a: Column, b: Column, body) -> Column:
    """body of both texts without their longest common beginning: what a pattern finds once more
    after the mark."""
    start = F.length(F.regexp_extract(F.concat(a, F.lit("\u0000"), b), "^([^\\x00]*)[^\\x00]*\\x00\\1", 1)) + 1
    return _let(start, lambda at: _let(F.struct(F.substr(a, at).alias("a"), F.substr(b, at).alias("b")), body))


def edits(a: Column, b: Column) -> Column:
    """Distance of two words if it is at most two, else 3 or more.

    A swap counts two in the built-in distance, so 0 and 1 need no second look. Otherwise common
    beginnings and ends are cut off. What is left differs at both ends, so one edit is at its start
    and one at its end: a swap there must be the first or the last two letters, and the rest is
    compared by the built-in distance. No text is edited twice, since each part is seen once.
    """
    def swap(x: Column, y: Column) -> Column:
        one, two = F.lit(1), F.lit(2)
        return (F.length(x) >= 2) & (F.length(y) >= 2) & (F.substr(x, one, one) == F.substr(y, two, one)) & (
            F.substr(x, two, one) == F.substr(y, one, one))

    def rest(x: Column, cut: int = 0) -> Column:
        return F.substr(x, F.lit(3), F.greatest(F.length(x) - 2 - cut, F.lit(0)))

    def judged(front: Column, back: Column, plain: Column) -> Column:
        fa, fb, ba, bb = front["a"], front["b"], back["a"], back["b"]
        two = (
            (swap(fa, fb) & (F.levenshtein(rest(fa), rest(fb)) <= 1)) | (swap(ba, bb) & (F.levenshtein(rest(ba), rest(bb)) <= 1))
            | (swap(fa, fb) & swap(ba, bb) & (F.length(fa) >= 4) & (rest(fa, 2) == rest(fb, 2))))
        one = swap(fa, fb) & (F.length(fa) == 2) & (F.length(fb) == 2)
        return F.when(one, 1).when((plain == 2) | two, 2).otherwise(F.greatest(plain, F.lit(3)))

    def cores(plain: Column) -> Column:
        turned = lambda c: F.struct(F.reverse(c["a"]).alias("a"), F.reverse(c["b"]).alias("b"))
        return _core(a, b, lambda c: _core(F.reverse(c["a"]), F.reverse(c["b"]), lambda back: _let(
            turned(back), lambda front: judged(front, back, plain))))

    return _let(F.levenshtein(a, b, 4), lambda plain: F.when(plain.between(0, 1), plain).when(
        plain.between(2, 4), cores(plain)).otherwise(5))


def allowed_edits(term: Column) -> Column:
    """AUTO: none up to 2 letters, one up to 5, two from 6."""
    size = F.length(term)
    return F.when(size <= 2, 0).when(size <= 5, 1).otherwise(2)


def without(text: Column, at: Column) -> Column:
    """The text without the letter at this place; place 0 takes none away."""
    return F.when(at == 0, text).otherwise(F.concat(F.substr(text, F.lit(1), at - 1), F.substr(text, at + 1)))


def _piece_start(size: Column, piece: Column) -> Column:
    return F.floor(size * piece / PIECES).cast("int")


def piece_keys(term: Column, query_size: Column, drift: int) -> Column:
    """Pieces of a long term, cut as for a query term of `query_size` letters.

    Two edits, even two swaps across borders, touch at most four of five pieces, and the one
    left has moved by at most two places: the query emits its own cuts (drift 0), the
    vocabulary emits them shifted by up to `drift`.
    """
    pieces = F.sequence(F.lit(0), F.lit(PIECES - 1))
    shifts = F.sequence(F.lit(-drift), F.lit(drift)) if drift else F.array(F.lit(0))

    def cut(piece, shift):
        start = _piece_start(query_size, piece)
        size = _piece_start(query_size, piece + 1) - start
        return F.when(start + shift >= 0, F.concat(
            piece.cast("string"), F.lit(":"), F.substr(term, start + shift + 1, size)))

    return F.array_distinct(F.array_compact(F.flatten(F.transform(
        pieces, lambda p: F.transform(shifts, lambda s: cut(p, s))))))


def key_class(query_size: Column) -> Column:
    """Which keys a query term of this length is found by: 1 or 2 deletions, or, for long ones,
    pieces cut for exactly this length."""
    return F.when(query_size <= 5, 1).when(query_size <= SHORT, 2).otherwise(query_size)


def reachable_classes(term: Column, query_sizes: Column) -> Column:
    """Key classes of the query lengths, out of an array of them, that a vocabulary term may match."""
    size = F.length(term)
    near = F.filter(query_sizes, lambda q: F.abs(q - size) <= F.when(q <= 5, 1).otherwise(2))
    return F.array_distinct(F.transform(near, key_class))


def match_keys(rows: DataFrame, term: str, is_query: bool) -> DataFrame:
    """`cls, key, term`: keys that a query term and every vocabulary term within its allowed
    edits share. Expects `term` and the class `cls`.

    The places to delete are exploded one after the other, so that the cutting itself runs in
    generated code.
    """
    text, cls, size = F.col(term), F.col("cls"), F.length(term)
    once = rows.where(cls <= 2).select("cls", term, F.explode(F.sequence(F.lit(0), size)).alias("_i")) \
        .select("cls", term, "_i", without(text, F.col("_i")).alias("_once"))
    again = F.when((cls == 2) & F.col("_i").between(1, size - 1),
                   F.concat(F.array(F.lit(0)), F.sequence(F.col("_i"), size - 1))).otherwise(F.array(F.lit(0)))
    short = once.select("cls", term, "_once", F.explode(again).alias("_j")).select(
        "cls", without(F.col("_once"), F.col("_j")).alias("key"), term)
    pieces = rows.where(cls > 2).select(
        "cls", F.explode(piece_keys(text, cls, 0 if is_query else 2)).alias("key"), term)
    return short.unionByName(pieces)
