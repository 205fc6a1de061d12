"""Operator 13: fill-in-middle transformation, cut at units that are found eight bytes at a time."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F, types as T

from .common import table, with_results

PREFIX, SUFFIX, MIDDLE = "<P>", "<S>", "<M>"
#: Of a hundred documents so many keep their text as it is, and of a hundred transformed ones so many have the suffix first.
PLAIN_SHARE, SPM_SHARE = 10, 20
#: Bytes of text that are marked at once; a longer text is a step of its own.
STEP = 1 << 20

_U = np.uint64
_HIGH, _LOW7, _FOLD = _U(0x8080808080808080), _U(0x7F7F7F7F7F7F7F7F), _U(0x2020202020202020)
_FROM_A, _PAST_Z = _U(0x1F1F1F1F1F1F1F1F), _U(0x0505050505050505)  # 0x80 - ord("a"), 0x80 - ord("z") - 1 in every byte
_ONES = ~_U(0)


def _letters(words: np.ndarray) -> np.ndarray:
    """The high bit of each byte that is an ASCII letter: in seven bits, adding 0x80 - x carries into the high bit from x on."""
    low = (words & _LOW7) | _FOLD
    return (low + _FROM_A) & ~(low + _PAST_Z) & ~words & _HIGH


def _continuations(words: np.ndarray) -> np.ndarray:
    """The high bit of each byte 10xxxxxx, that goes on with a code point."""
    return words & ~(words << _U(1)) & _HIGH


def _following(marks: np.ndarray) -> np.ndarray:
    """For each byte the mark of the one after it (the words are little-endian)."""
    return (marks >> _U(8)) | (np.append(marks[1:], _U(0)) << _U(56))


class Units:
    """Unit ends and code points of several texts, each in words of its own with at least one byte of padding behind it."""

    def __init__(self, texts: list[bytes]) -> None:
        sizes = np.fromiter(map(len, texts), np.int64, len(texts))
        raw = b"".join(t + bytes(8 - len(t) % 8) for t in texts)
        words = np.frombuffer(raw, "<u8").astype(_U, copy=False)
        self.first = np.concatenate((np.zeros(1, np.int64), np.cumsum(sizes // 8 + 1)))
        letters, inner = _letters(words), _continuations(words)
        # a unit ends at a byte unless a letter goes on with a letter or a code point with its next byte
        ends = ~((letters & _following(letters)) | _following(inner)) & _HIGH
        starts = ~inner & _HIGH
        last, kept = self.first[1:] - 1, (_U(1) << (_U(8) * (sizes % 8).astype(_U))) - _U(1)
        ends[last] &= kept
        starts[last] &= kept
        self.ends, self.starts = ends, starts
        self.sum_ends, self.sum_starts = (np.concatenate((np.zeros(1, np.int64), np.cumsum(np.bitwise_count(x), dtype=np.int64))) for x in (ends, starts))
        self.n = np.diff(self.sum_ends[self.first])

    def cut(self, units: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """For each text the bytes and the code points of its first `units` units."""
        before = self.sum_ends[self.first[:-1]]
        at = np.searchsorted(self.sum_ends, before + units, "left") - 1  # the word with that unit's end
        none = units == 0
        at = np.where(none, self.first[:-1], at)
        rank, word = before + units - self.sum_ends[at], self.ends[at]
        for _ in range(7):  # drop the lowest marks until the wanted one is the lowest
            word = np.where(rank > 1, word & (word - _U(1)), word)
            rank = rank - 1
        below = (word & (~word + _U(1))) - _U(1)  # all bits under the mark: 8 a byte, less one
        upto = np.where(none, _U(0), (below << _U(1)) | _U(1))
        inside = np.bitwise_count(upto).astype(np.int64) // 8
        points = self.sum_starts[at] - self.sum_starts[self.first[:-1]] + np.bitwise_count(self.starts[at] & upto)
        return np.where(none, 0, (at - self.first[:-1]) * 8 + inside), np.where(none, 0, points)


def _steps(texts: list[bytes]) -> Iterator[tuple[int, int]]:
    a = size = 0
    for b, t in enumerate(texts):
        if b > a and size + len(t) > STEP:
            yield a, b
            a, size = b, 0
        size += len(t)
    if texts:
        yield a, len(texts)


ADDED = "n long, form string, prefix_chars long, middle_chars long, output string"


def _transform(texts: pa.Array, draws: list[pa.Array], plain_share: int, spm_share: int) -> list[pa.Array]:
    raws = [(t.as_py() or "").encode() for t in texts]
    h = [d.to_numpy(zero_copy_only=False).astype(np.int64) for d in draws]
    marks = [m.encode() for m in (PREFIX, SUFFIX, MIDDLE)]
    n, forms, before, between, out = [], [], [], [], []
    for a, b in _steps(raws):
        u = Units(raws[a:b])
        x, y = h[0][a:b] % (u.n + 1), h[1][a:b] % (u.n + 1)
        (first, p_chars), (second, m_chars) = u.cut(np.minimum(x, y)), u.cut(np.maximum(x, y))
        n += u.n.tolist()
        for i, raw in enumerate(raws[a:b]):
            if not raw or h[2][a + i] % 100 >= 100 - plain_share or any(m in raw for m in marks):
                form, made = "plain", raw
            else:
                p, s, m = raw[: first[i]], raw[second[i] :], raw[first[i] : second[i]]
                form = "spm" if h[3][a + i] % 100 < spm_share else "psm"
                made = b"".join((marks[1], s, marks[0], p, marks[2], m) if form == "spm" else (marks[0], p, marks[1], s, marks[2], m))
            plain = form == "plain"
            forms.append(form)
            before.append(None if plain else int(p_chars[i]))
            between.append(None if plain else int(m_chars[i] - p_chars[i]))
            out.append(made.decode())
    return [pa.array(n, pa.int64()), pa.array(forms, pa.string()), pa.array(before, pa.int64()), pa.array(between, pa.int64()), pa.array(out, pa.string())]


def fill_in_middle(docs: DataFrame, text: str = "text", key: str = "doc_id", seed: int = 1, plain_share: int = PLAIN_SHARE, spm_share: int = SPM_SHARE) -> DataFrame:
    """docs with n (its units: runs of ASCII letters, and every other code point alone), form, prefix_chars, middle_chars and
    output, the text with its middle moved to the end.

    Two draws from the row's key choose the cuts. Units are marked in UTF-8 as 64-bit words: arithmetic marks the last byte of
    each, counts of marks per word are summed, a cut is searched in these sums and then selected inside its word. No row moves.
    Null texts count as empty, null keys as the empty text; a text that is empty or holds a sentinel stays as it is (form plain,
    null lengths). Equal rows have equal results. Columns with the names of the new ones give way; all others stay.
    """
    hexed = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col(f"`{key}`").cast("string"), F.lit(""))), 256)
    draw = lambda i: F.conv(F.substring(hexed, 1 + 8 * i, 8), 16, 10).cast("long")
    draws = F.struct(*[draw(i).alias(f"h{i}") for i in range(4)])
    names = [c for c in docs.columns if c.lower() not in ("n", "form", "prefix_chars", "middle_chars", "output")]
    # the text and the draws travel as one struct, so that no name of docs can meet theirs
    rows = docs.select(*[F.col(f"`{c}`") for c in names], F.struct(F.col(f"`{text}`").cast("string").alias("text"), draws.alias("draws")).alias("_cut"))

    def found(given: pa.StructArray) -> list[pa.Array]:
        return _transform(given.field(0), given.field(1).flatten(), plain_share, spm_share)

    plain = rows.toDF(*[f"k{i}" for i in range(len(names))], "_cut")
    made = with_results(plain, "_cut", plain.columns[:-1], ADDED, found)
    return made.toDF(*names, *[f.name for f in T._parse_datatype_string(ADDED)])


def restored(output: Column, form: Column) -> Column:
    """The text that a row of the given form and output was made of."""
    part = lambda after, before: F.substring_index(F.substring_index(output, after, -1), before, 1)
    middle = F.substring_index(output, MIDDLE, -1)
    return F.when(form == "plain", output).when(form == "spm", F.concat(part(PREFIX, MIDDLE), middle, part(SUFFIX, PREFIX))).otherwise(F.concat(part(PREFIX, SUFFIX), middle, part(SUFFIX, MIDDLE)))


def op13_fill_in_middle(spark, sf_dir):
    made = fill_in_middle(table(spark, sf_dir, "documents").select("doc_id", "text"))
    digest = lambda c: F.sha2(c.cast("binary"), 256)
    return made.select("doc_id", "n", "form", "prefix_chars", "middle_chars", digest(F.col("output")).alias("output_sha256"), digest(restored(F.col("output"), F.col("form"))).alias("restored_sha256"))


SQL = r"""
WITH d AS (SELECT doc_id, coalesce(text, '') AS x, sha256('1:' || coalesce(CAST(doc_id AS VARCHAR), '')) AS h FROM documents),
     u AS (SELECT *, regexp_extract_all(x, '[A-Za-z]+|[^A-Za-z]') AS w FROM d),
     n AS (SELECT *, CAST(len(w) AS BIGINT) AS n, list_transform(range(4), lambda i: CAST('0x' || substr(h, CAST(1 + 8 * i AS INTEGER), 8) AS BIGINT)) AS r FROM u),
     c AS (SELECT *, least(r[1] % (n + 1), r[2] % (n + 1)) AS a, greatest(r[1] % (n + 1), r[2] % (n + 1)) AS b,
                  CASE WHEN x = '' OR contains(x, '<P>') OR contains(x, '<S>') OR contains(x, '<M>') OR r[3] % 100 >= 90 THEN 'plain' WHEN r[4] % 100 < 20 THEN 'spm' ELSE 'psm' END AS form FROM n),
     p AS (SELECT *, array_to_string(w[1:a], '') AS pre, array_to_string(w[a + 1:b], '') AS mid, array_to_string(w[b + 1:], '') AS suf FROM c)
SELECT doc_id, n, form, CASE WHEN form <> 'plain' THEN length(pre) END AS prefix_chars, CASE WHEN form <> 'plain' THEN length(mid) END AS middle_chars,
       sha256(CASE form WHEN 'plain' THEN x WHEN 'psm' THEN '<P>' || pre || '<S>' || suf || '<M>' || mid ELSE '<S>' || suf || '<P>' || pre || '<M>' || mid END) AS output_sha256,
       sha256(x) AS restored_sha256 FROM p
"""
