"""One form for texts that look the same on the screen.

Each batch of texts becomes one array of positioned code points. Small tables (decompositions, look-alikes, combining classes,
compositions), built once per worker from the Unicode data and the fixed lists below, are joined to it by code point: characters
are decomposed and replaced by their plain look-alike, invisible ones leave, combining marks are ordered by class, and pairs are
composed again. Texts without any character that a table changes are passed through.
"""

from __future__ import annotations

import sys
import unicodedata
from functools import lru_cache

import numpy as np
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from rosta.session import written

# Letters that look like a plain Latin letter, by the Latin letter.
LOOKALIKES = {
    "A": "АΑᎪꓮ", "B": "ВΒᏴꓐ", "C": "СϹᏟꓚ", "D": "Ꭰꓓ", "E": "ЕΕᎬꓰ", "H": "НΗᎻꓧ", "I": "ІΙӀꓲ", "J": "ЈͿᎫꓙ", "K": "КΚᏦꓗ", "L": "ԼᏞꓡ", "M": "МΜᎷꓟ",
    "N": "Νꓠ", "O": "ОΟՕꓳ", "P": "РΡᏢꓑ", "Q": "Ԛ", "S": "ЅՏᏚꓢ", "T": "ТΤᎢꓔ", "U": "Սꓴ", "V": "ѴᏙꓦ", "W": "ԜᎳꓪ", "X": "ХΧꓫ", "Y": "УΥҮꓬ", "Z": "ΖᏃꓜ",
    "a": "аɑα", "c": "сϲ", "d": "ԁ", "e": "е", "g": "ɡց", "h": "һհ", "i": "іι", "j": "јϳյ", "l": "ӏ", "n": "ո", "o": "оοօ", "p": "рρ",
    "q": "ԛզ", "s": "ѕ", "u": "ս", "v": "ѵν", "w": "ԝ", "x": "х", "y": "уү",
    "-": "‐‑",
    "F": "ꓝ", "G": "ꓖ", "R": "ꓣ",
}

# Ranges of compatibility characters that look like what they decompose to, besides wide forms and spaces.
SAME_LOOK = [(0x0132, 0x0133), (0x01C4, 0x01CC), (0x01F1, 0x01F3), (0x2160, 0x217F), (0xFB00, 0xFB06), (0x00B5, 0x00B5)]

# Characters without any look of their own, as ranges; joiners within pictographs stay.
INVISIBLE = [(0x00, 0x08), (0x0B, 0x0C), (0x0E, 0x1F), (0x7F, 0x84), (0x86, 0x9F), (0xAD, 0xAD), (0x34F, 0x34F), (0x61C, 0x61C), (0x180B, 0x180F), (0x200B, 0x200F), (0x202A, 0x202E), (0x2060, 0x206F), (0xFE00, 0xFE0F), (0xFEFF, 0xFEFF), (0xFFF9, 0xFFFB), (0xE0000, 0xE0FFF)]

JOINER = 0x200D


class Tables:
    """All mappings by code point."""

    def __init__(self) -> None:
        size = sys.maxunicode + 1
        plain = {ord(c): ord(latin) for latin, others in LOOKALIKES.items() for c in others}
        same = {c for a, b in SAME_LOOK for c in range(a, b + 1)}
        parts: dict[int, list[int]] = {}
        for c in range(0x80, size):
            if 0xD800 <= c <= 0xDFFF:
                continue
            ch = chr(c)
            out = unicodedata.normalize("NFD", ch)
            given = unicodedata.decomposition(ch)
            if given.startswith(("<wide>", "<narrow>")) or c in same:
                out = unicodedata.normalize("NFKD", ch)
            elif given.startswith(("<compat>", "<noBreak>")) and given.split()[1:] == ["0020"]:
                out = " "
            elif given == "<noBreak> 2010":
                out = "-"
            if out in "\u2002\u2003":  # what EN QUAD and EM QUAD decompose to
                out = " "
            codes = [plain.get(ord(x), ord(x)) for x in out]
            if codes != [c]:
                parts[c] = codes
        self.ccc = np.zeros(size, np.uint8)
        for c in range(0x300, size):
            if k := unicodedata.combining(chr(c)):
                self.ccc[c] = k
        self.hidden = np.zeros(size, bool)
        for a, b in INVISIBLE:
            self.hidden[a : b + 1] = True
        for c in np.flatnonzero(self.hidden):
            parts.pop(int(c), None)
        self.length = np.ones(size, np.int64)
        self.first = np.zeros(size, np.int64)
        flat: list[int] = []
        for c, codes in parts.items():
            self.length[c], self.first[c] = len(codes), len(flat)
            flat += codes
        self.flat = np.array(flat, np.uint32)
        self.changed = np.zeros(size, bool)
        self.changed[[*parts]] = True
        self.pictograph = np.zeros(size, bool)
        for a, b in ((0x2190, 0x2BFF), (0x1F000, 0x1FAFF)):
            self.pictograph[a:b] = True
        self.pairs: dict[tuple[int, int], int] = {}
        for c in range(0xC0, size):
            given = unicodedata.decomposition(chr(c)) if not 0xAC00 <= c <= 0xD7A3 else ""
            if given and not given.startswith("<") and len(x := given.split()) == 2 and unicodedata.normalize("NFC", chr(c)) == chr(c):
                self.pairs[int(x[0], 16), int(x[1], 16)] = c
        # what these tables never change: one test decides whether a text passes through (a character is a fixed point if it
        # composes from its own parts and no mark can follow it unseen)
        self.touch = self.changed | self.hidden | (self.ccc > 0)
        for c, codes in parts.items():
            if len(codes) == 2 and self.pairs.get((codes[0], codes[1])) == c:
                self.touch[c] = False
        self.touch[0x0D] = True
        self.touch[0x1100:0x1200] = True

    def compose(self, a: int, b: int) -> int | None:
        """The character of a pair, Hangul by rule."""
        if 0x1100 <= a < 0x1113 and 0x1161 <= b < 0x1176:
            return 0xAC00 + ((a - 0x1100) * 21 + b - 0x1161) * 28
        if 0xAC00 <= a <= 0xD7A3 and (a - 0xAC00) % 28 == 0 and 0x11A7 < b < 0x11C3:
            return a + b - 0x11A7
        return self.pairs.get((a, b))


@lru_cache(1)
def tables() -> Tables:
    """One set per Python worker."""
    return Tables()


def _unify(codes: np.ndarray, text_no: np.ndarray, n_texts: int) -> tuple[np.ndarray, np.ndarray]:
    """Code points of several texts to their one form; (code points, text of each)."""
    t = tables()
    # line ends: CR LF and CR are one line feed
    cr = codes == 0x0D
    if cr.any():
        lone = cr.copy()
        lone[:-1] &= ~((codes[1:] == 0x0A) & (text_no[1:] == text_no[:-1]))
        codes = np.where(lone, 0x0A, codes).astype(np.uint32)
        keep = ~(cr & ~lone)
        codes, text_no = codes[keep], text_no[keep]
    gone = t.hidden[codes]
    join = np.flatnonzero(codes == JOINER)
    join = join[(join > 0) & (join < len(codes) - 1)]
    gone[join] &= ~((t.pictograph[codes[join - 1]] | t.hidden[codes[join - 1]]) & t.pictograph[codes[join + 1]])
    codes, text_no = codes[~gone], text_no[~gone]
    # decomposition and look-alikes, joined by code point
    count = t.length[codes]
    at = np.repeat(np.cumsum(count) - count, count)
    step = np.arange(len(at)) - at
    source = np.repeat(codes, count)
    text_no = np.repeat(text_no, count)
    moved = t.changed[source]
    out = source.copy()
    out[moved] = t.flat[t.first[source[moved]] + step[moved]]
    # marks in the order of their classes
    ccc = t.ccc[out]
    if ccc.any():
        starter = np.cumsum(ccc == 0) + text_no
        order = np.lexsort((np.arange(len(out)), ccc, starter))
        out, ccc = out[order], ccc[order]
    # composition: every character after one that it can compose with
    jamo = (out >= 0x1161) & (out < 0x11C3)
    dead = []
    base, last, follows = -1, 0, -1
    for i in np.flatnonzero((ccc > 0) | jamo).tolist():
        k = int(ccc[i])
        if i != follows or text_no[i] != text_no[i - 1]:  # the first of its run: its base is the character before it
            base = i - 1 if i and text_no[i - 1] == text_no[i] else -1
            last = 0
        follows = i + 1
        whole = t.compose(int(out[base]), int(out[i])) if base >= 0 and not (last and last >= k) else None
        if whole is not None:
            out[base] = whole
            dead.append(i)
        elif k:
            last = k
        else:  # a starter that stays is the next base
            base, last = i, 0
    if dead:
        keep = np.ones(len(out), bool)
        keep[dead] = False
        out, text_no = out[keep], text_no[keep]
    return out, text_no


def unify(texts: list[str | None]) -> list[str | None]:
    """The one form of each text; null stays null."""
    t = tables()
    out = list(texts)
    some = [i for i, s in enumerate(texts) if s and not (s.isascii() and s.isprintable())]
    if not some:
        return out
    joined = "".join(texts[i] for i in some)
    codes = np.frombuffer(joined.encode("utf-32-le", "surrogatepass"), np.uint32)
    text_no = np.repeat(np.arange(len(some)), [len(texts[i]) for i in some])
    touched = np.unique(text_no[t.touch[codes]])
    mask = np.zeros(len(some), bool)
    mask[touched] = True
    pick = mask[text_no]
    new, owner = _unify(codes[pick].copy(), text_no[pick], len(some))
    ends = np.searchsorted(owner, touched, "right").tolist()
    begins = np.searchsorted(owner, touched, "left").tolist()
    whole = new.astype("<u4").tobytes().decode("utf-32-le", "surrogatepass")
    for k, a, b in zip(touched.tolist(), begins, ends, strict=True):
        out[some[k]] = whole[a:b]
    return out


def canonical(df: DataFrame, key: str, text: str) -> DataFrame:
    """(key, canonical) for every row: ``text`` in the one form of all texts that look like it.

    Wide and narrow forms, spaces of any width, combining accents, invisible characters and look-alike letters are brought to one
    form; case, accents, digits, superscripts, line breaks and the number of spaces stay. A null text stays null, an empty one
    empty. Repeated rows give repeated results; further columns of any name are ignored. Texts of any length are taken whole.
    """

    def run(batches):  # noqa: ANN001, ANN202
        import pyarrow as pa

        for given in batches:
            yield pa.RecordBatch.from_arrays([given.column(0), pa.array(unify(given.column(1).to_pylist()), pa.string())], names=["_key", "_canonical"])

    kind = dict(df.dtypes)[key]
    out = df.select(F.col(f"`{key}`").alias("_key"), F.col(f"`{text}`").alias("_text")).mapInArrow(run, f"_key {kind}, _canonical string")
    return out.toDF(key, "canonical")


def canonical_by_joins(df: DataFrame, key: str, text: str) -> DataFrame:
    """(key, canonical) as ``canonical``, but as relational steps: texts exploded to positioned code points, broadcast joins with the mappings, marks ordered by class, strings rebuilt.

    The mappings are broadcast: their size is that of the Unicode data. Only texts that a mapping touches are exploded, and each of these is grouped
    again by its key, so keys are expected to name a row. It is kept for comparison: it moves one row for each code point of a touched text.
    """
    spark, t = df.sparkSession, tables()
    changed = [(int(c), [int(x) for x in t.flat[t.first[c] : t.first[c] + t.length[c]]]) for c in np.flatnonzero(t.changed)]
    parts = F.broadcast(spark.createDataFrame(changed, "code int, parts array<int>"))
    classes = F.broadcast(spark.createDataFrame([(int(c), int(t.ccc[c])) for c in np.flatnonzero(t.ccc)], "code int, class int"))
    hidden = F.broadcast(spark.createDataFrame([(int(c),) for c in np.flatnonzero(t.hidden) if c != JOINER], "code int"))
    base = df.select(F.col(f"`{key}`").alias("_key"), F.col(f"`{text}`").alias("_text"))
    plain = F.col("_text").isNull() | F.col("_text").rlike(r"^[\x09\x0a\x20-\x7e]*$")
    lines = F.regexp_replace(F.regexp_replace("_text", "\r\n", "\n"), "\r", "\n")
    each = base.filter(~plain).select("_key", F.posexplode(F.split(lines, "")).alias("place", "char")).filter("char <> ''").select("_key", "place", F.ascii("char").alias("code"))
    each = each.join(hidden, "code", "left_anti").join(parts, "code", "left")
    each = each.select("_key", "place", F.posexplode(F.coalesce("parts", F.array("code"))).alias("step", "code")).join(classes, "code", "left").withColumn("class", F.coalesce("class", F.lit(0)))
    rows = each.groupBy("_key").agg(F.sort_array(F.collect_list(F.struct("place", "step", "code", "class"))).alias("codes"))

    def run(batches):  # noqa: ANN001, ANN202
        import pyarrow as pa

        for given in batches:
            out = [_recomposed([(c["code"], c["class"]) for c in codes]) for codes in given.column("codes").to_pylist()]
            yield pa.RecordBatch.from_arrays([given.column("_key"), pa.array(out, pa.string())], names=["_key", "canonical"])

    kind = dict(base.dtypes)["_key"]
    rebuilt = rows.mapInArrow(run, f"_key {kind}, canonical string")
    whole = base.join(rebuilt, "_key", "left").select("_key", F.when(plain, lines).otherwise(F.coalesce("canonical", F.lit(""))).alias("canonical"))
    return whole.toDF(key, "canonical")


def _recomposed(codes: list[tuple[int, int]]) -> str:
    """Code points with their classes to a string: runs of marks ordered by class, pairs composed."""
    t, out, k = tables(), [], 0
    while k < len(codes):
        end = k + 1
        while end < len(codes) and codes[end][1]:
            end += 1
        run = [codes[k], *sorted(codes[k + 1 : end], key=lambda c: c[1])] if not codes[k][1] else sorted(codes[k:end], key=lambda c: c[1])
        base, last, kept = (run[0][0], 0, []) if not run[0][1] else (None, 0, [run[0]])
        if base is not None and out and not codes[k][1] and (whole := t.compose(out[-1], base)) is not None and 0x1161 <= base < 0x11C3:
            out[-1] = whole
            base = None
            run = run[:1] if len(run) == 1 else run
        for code, mark in run[1:]:
            whole = t.compose(base, code) if base is not None and not (last and last >= mark) else None
            if whole is not None:
                base = whole
            else:
                kept.append((code, mark))
                last = mark
        out += ([base] if base is not None else []) + [c for c, _ in kept]
        k = end
    return "".join(map(chr, out))


def _looks(df: DataFrame, key: str, text: str) -> DataFrame:
    """(id, look, variant): hashes of the one form and of the text itself of every row with a key and a visible character."""

    def run(batches):  # noqa: ANN001, ANN202
        import hashlib

        import pyarrow as pa

        for given in batches:
            keys, looks, texts = [], [], []
            raw = given.column(1).to_pylist()
            for k, t, u in zip(given.column(0).to_pylist(), raw, unify(raw), strict=True):
                if k is not None and u and not u.isspace():
                    keys.append(k)
                    looks.append(hashlib.sha256(u.encode("utf-8", "surrogatepass")).digest())
                    texts.append(hashlib.sha256(t.encode("utf-8", "surrogatepass")).digest())
            yield pa.RecordBatch.from_arrays([pa.array(keys, given.column(0).type), pa.array(looks, pa.binary()), pa.array(texts, pa.binary())], names=["id", "look", "variant"])

    kind = dict(df.dtypes)[key]
    hashed = df.select(F.col(f"`{key}`").alias("_key"), F.col(f"`{text}`").alias("_text")).mapInArrow(run, f"id {kind}, look binary, variant binary")
    return written(hashed, "looks")  # two hashes a row: the texts are read and unified once


def lookalike_classes(df: DataFrame, key: str, text: str) -> DataFrame:
    """(key, class_id, variant_no, links) of every row whose text looks like another one that differs in its characters.

    class_id is the smallest key of all rows that look the same, variant_no numbers their different texts from 1 (by their hash), links is
    the number of rows of the class with another text. Nothing is paired, so a class of any size takes one row for each member. Rows that
    give no pairs in ``lookalike_pairs`` are left out; a key that repeats has a row for each of its rows.
    """
    rows = _looks(df, key, text)
    variants = rows.groupBy("look", "variant").agg(F.count("*").alias("n"), F.min("id").alias("first"))
    classes = variants.groupBy("look").agg(F.sum("n").alias("all"), F.min("first").alias("class_id"), F.count("*").alias("variants")).filter("variants > 1")
    # a class has as many variants as there are spellings of one text, whatever its number of rows
    order = Window.partitionBy("look").orderBy("variant")
    named = variants.join(classes, "look").select("look", "variant", "class_id", F.row_number().over(order).alias("variant_no"), (F.col("all") - F.col("n")).alias("links"))
    return rows.join(named, ["look", "variant"]).select(F.col("id").alias(key), "class_id", "variant_no", "links")


def lookalike_pairs(df: DataFrame, key: str, text: str) -> DataFrame:
    """(doc_a, doc_b), doc_a < doc_b: pairs of rows whose texts look the same but differ in their characters.

    Rows meet by a hash of the one form; variants (distinct texts) are paired first, so that exact copies are counted before
    any of them is joined, and only groups with two variants go on to their documents. Null keys, null texts and texts without
    a visible character give no pairs; a key that repeats gives each of its pairs once.
    """

    rows = _looks(df, key, text)
    # groups with several variants, found by two running extremes per group: no group is collected
    mixed = rows.groupBy("look").agg(F.min("variant").alias("low"), F.max("variant").alias("high")).filter("low <> high").select("look")
    members = rows.join(mixed, "look", "left_semi")
    variants = members.select("look", "variant").distinct()
    one, two = variants.toDF("look", "variant_a"), variants.toDF("look", "variant_b")
    kinds = one.join(two, "look").filter("variant_a <> variant_b").drop("look")
    a, b = members.select(F.col("id").alias("doc_a"), F.col("variant").alias("variant_a")), members.select(F.col("id").alias("doc_b"), F.col("variant").alias("variant_b"))
    return a.join(kinds, "variant_a").join(b, "variant_b").filter("doc_a < doc_b").select("doc_a", "doc_b").distinct()
