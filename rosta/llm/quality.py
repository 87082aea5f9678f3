"""Text quality statistics and outlierness: prose against lists, tables and junk.

Statistics are counted for whole batches at once over arrays of character classes. A prose model (mean and covariance of all
statistics) is estimated for each language and length class over all texts: from medians and median deviations, then in
concentration steps that keep the texts near the model. The squared Mahalanobis distance of a text is its outlierness; each
statistic's contribution adds up to it. No statistic grows with the length of a text: counts are shares, repeated words are looked for
among the words just before, and the words of a line count by a curve that levels off.
"""

from __future__ import annotations

import re
import sys
import unicodedata
from collections import Counter
from functools import lru_cache

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rosta.llm.personal import mentions, name_pairs
from rosta.session import written

STATISTICS = ("common_share", "log_mean_word", "symbol_ratio", "digit_ratio", "separator_rate", "end_share", "line_fill", "repeat_share", "vowel_share", "long_share", "mixed_share", "line_break_rate", "cluster_share")
COUNTS = ("chars", "words", "lines")
WHOLE = ("text_chars", "text_words", "text_lines")  # counts of the text as it is
LENGTHS = (8, 20)  # words up to which a text is short or middling
LETTER, DIGIT, BLANK, BREAK, POINT, SEPARATOR, SYMBOL, VOWEL = range(8)

# Vowels, marks that end a sentence, marks between parts of a row.
VOWELS = "aeiouyáéíóöőúüűäàâèêëîïôûаеёиоуыэюя"
POINTS = ".!?…)\"”:"
SEPARATORS = ",;|:\t/+=»<>"
_WORD = re.compile(r"\w+")
_SPACED = re.compile(r"(?<![^\W_])(?:[^\W_\d][ .]){3,}[^\W_\d](?![^\W_])")
_THREE = re.compile(r"\d{3}|[nN][uU][lL][lL][aA] [hH]")
# a house number behind a kind of public place: looked at from its first digit, which is quick to find
_HOUSE = re.compile(
    r"(?=\d)(?:(?<=[uU]\. )|(?<=[uU][tT][cC][aA] )|(?<=[úÚ][tT] )|(?<=[tT][éÉ][rR] )|(?<=[kK][öÖ][zZ] )|(?<=[sS][oO][rR] )|(?<=[tT][áÁ][nN][yY] )|(?<=[űŰ][lL][őŐ] )|(?<=[eE][eE][tT] )|(?<=[oO][aA][dD] )|(?<=[ßsS][eE] )|(?<=[tT][rR]\. ))"
)
_SIGN = re.compile(r"@|[kK][uU][kK][aA][cC]|\b[aA][tT]\b")
# Kinds of public places of the languages.
PLACES = frozenset("utca utcája út útja u tér tere köz köze sor sora sétány sétánya dűlő krt körút fasor rakpart liget street road avenue lane straße strasse gasse platz weg allee ул".split())
#: Words before a word among which it is a repetition.
AMONG = 40
#: Letters from which a word is long, and the words of a line at which a line is half full.
LONG, HALF = 12, 12
#: Squared distance from which a text as a whole is no prose.
LEAST = 40.0


@lru_cache(1)
def _classes() -> np.ndarray:
    out = np.full(sys.maxunicode + 1, SYMBOL, np.uint8)
    for c in range(sys.maxunicode + 1):
        kind = unicodedata.category(chr(c))
        if kind[0] in "LM":
            out[c] = LETTER
        elif kind[0] == "N":
            out[c] = DIGIT
        elif kind[0] == "Z" or kind == "Cf":
            out[c] = BLANK
    for chars, kind in ((VOWELS + VOWELS.upper(), VOWEL), (POINTS, POINT), (SEPARATORS, SEPARATOR), (" \r ", BLANK), ("\n", BREAK), ("'’-_", BLANK)):
        for c in chars:
            out[ord(c)] = kind
    out[ord(":")] = SEPARATOR
    return out


def contacts(text: str) -> list[tuple[int, int]]:
    """Places of e-mail addresses, telephone and identity numbers and street addresses, apart from each other, in order."""
    numbers, houses = _THREE.search(text) is not None, _HOUSE.search(text) is not None
    if not numbers and not houses and not _SIGN.search(text):
        return []
    out: list[tuple[int, int]] = []
    found = mentions(text, numbers, houses)
    for a, b in sorted((a, b) for kind, head, a, b, _ in found if not head.startswith("groups") and (kind != "address" or head in PLACES)):
        if not out or a >= out[-1][1]:
            out.append((a, b))
    return out


#: Share of a line that contact data must cover for the line to be one of contact data; two capitalised words must be two fifths of it.
CONTACT = 0.2


def core(text: str) -> str:
    """``text`` without contact data: whole lines of it before or after the rest, and what stands within a text of one line.

    A word spaced out letter by letter is one word. Texts and lines of all lengths are treated alike.
    """
    text = _SPACED.sub(lambda m: m.group().replace(" ", "").replace(".", ""), text.replace("&nbsp;", " ").replace("\u00a0", " "))
    if "\n" not in text.strip():
        for a, b in reversed(contacts(text)):
            text = text[:a] + text[b:]
        return text

    def contact(line: str) -> bool:
        if sum(b - a for a, b in contacts(line)) >= CONTACT * len(line.strip()):
            return True
        return 5 * sum(b - a for *_, a, b in name_pairs(line)) >= 2 * len(line.strip())

    lines = [line for line in text.split("\n") if line.strip()]
    a, b = 0, len(lines)
    if not (_THREE.search(text) or _HOUSE.search(text) or _SIGN.search(text)):
        return text
    while a < b - 1 and contact(lines[a]):
        a += 1
    while b > a + 1 and contact(lines[b - 1]):
        b -= 1
    return "\n".join(lines[a:b])


def statistics(texts: list[str], common: dict[str, int], languages: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(statistics by text, counts by text, language number by text or -1) of non-empty texts.

    common: folded word to the bits of the languages that have it among their frequent words.
    """
    joined = "\n".join(texts) + "\n"
    codes = np.frombuffer(joined.encode("utf-32-le", "surrogatepass"), np.uint32)
    size = np.array([len(t) + 1 for t in texts])
    starts = np.concatenate([[0], np.cumsum(size)[:-1]])
    kind = _classes()[codes]
    add = lambda mask: np.add.reduceat(mask.view(np.uint8), starts, dtype=np.int64)
    letter, digit = (kind == LETTER) | (kind == VOWEL), kind == DIGIT
    letters, digits, vowels = add(letter), add(digit), add(kind == VOWEL)
    symbols, separators = add(kind == SYMBOL), add(kind == SEPARATOR)
    n = np.maximum(size - 1, 1)
    # words: runs of letters and digits
    inside = letter | digit
    begin = inside.copy()
    begin[1:] &= ~inside[:-1]
    at = np.flatnonzero(begin)
    stop = inside.copy()
    stop[:-1] &= ~inside[1:]
    length = np.flatnonzero(stop) + 1 - at
    words = add(begin)
    over = np.zeros(len(codes), np.int64)
    over[at] = np.maximum(length - LONG, 0)
    over = np.add.reduceat(over, starts)
    some_digit = np.zeros(len(codes) + 1, np.int64)
    some_digit[1:] = np.cumsum(digit)
    has_digit = (some_digit[at + length] - some_digit[at]) > 0
    mixed = np.zeros(len(codes), bool)
    mixed[at[has_digit]] = True
    mixed = add(mixed)
    # runs of four consonants and more, by their letters
    consonant = letter & (kind != VOWEL)
    head = consonant.copy()
    head[1:] &= ~consonant[:-1]
    tail = consonant.copy()
    tail[:-1] &= ~consonant[1:]
    head_at = np.flatnonzero(head)
    run = np.flatnonzero(tail) + 1 - head_at
    cluster = np.zeros(len(codes), np.int64)
    cluster[head_at] = np.where(run >= 4, run, 0)
    cluster = np.add.reduceat(cluster, starts)
    # lines: the last visible character before each break
    visible = np.where((kind == BLANK) | (kind == BREAK), -1, np.arange(len(codes)))
    last = np.maximum.accumulate(visible)
    breaks = np.flatnonzero(kind == BREAK)
    previous = np.concatenate([[-1], breaks[:-1]])
    end = last[breaks]
    full = end > previous
    ended = full & (kind[np.maximum(end, 0)] == POINT)
    line, good = np.zeros(len(codes), bool), np.zeros(len(codes), bool)
    line[breaks[full]] = True
    good[breaks[ended]] = True
    lines, ends = np.maximum(add(line), 1), add(good)
    # words by their text: frequent words of a language, and words that occurred among the ``AMONG`` before
    hits = np.zeros((len(texts), languages), np.int64)
    repeats = np.zeros(len(texts), np.int64)
    bits = [1 << k for k in range(languages)]
    for i, t in enumerate(texts):
        found = _WORD.findall(t.lower())
        for word, times in Counter(x for x in found if x in common).items():
            for k in range(languages):
                if common[word] & bits[k]:
                    hits[i, k] += times
        if len(found) <= AMONG:
            repeats[i] = len(found) - len(set(found))
        else:
            last: dict[str, int] = {}
            for place, word in enumerate(found):
                if place - last.get(word, -AMONG - 1) <= AMONG:
                    repeats[i] += 1
                last[word] = place
    language = np.where(hits.max(axis=1) > 0, hits.argmax(axis=1), -1)
    w = np.maximum(words, 1)
    values = np.stack(
        [
            hits.max(axis=1) / w,
            np.log((letters + digits) / w + 1),
            symbols / n,
            digits / n,
            separators / w,
            ends / lines,
            words / (words + HALF * lines),
            repeats / w,
            vowels / np.maximum(letters, 1),
            over / np.maximum(letters + digits, 1),
            mixed / w,
            (lines - 1) / w,
            cluster / np.maximum(letters, 1),
        ],
        axis=1,
    )
    return values, np.stack([size - 1, words, lines], axis=1), language


def measured(df: DataFrame, keys: list[str], text: str, common: list[tuple[str, str]], default: str = "hu", least: int | None = 20, whole_too: bool = True) -> DataFrame:
    """(keys, language, contact, chars, words, lines, one column per statistic, the same of the whole text) of every text of at least ``least`` characters.

    contact: whether a text is all contact data.
    chars, words, lines and the statistics leave out lines of contact data around a text, unless it is all contact data; text_chars,
    text_words, text_lines and text_statistics (an array in the order of ``STATISTICS``) are those of the whole text.

    Without ``whole_too`` of these only text_chars is there.

    common: (language, word) rows, a fixed list of frequent words. A text without any of them has the language ``default``.
    Null, empty, blank and shorter texts give no rows. With ``least`` None every text gives a row: one without visible characters
    has no language, counts of 0 but text_chars, and statistics of 0; a null text has null for text_chars, text_words, text_lines and text_statistics.
    """
    languages = sorted({lang for lang, _ in common} | {default})
    table: dict[str, int] = {}
    for lang, word in common:
        for form in {word.lower(), _fold(word.lower())}:
            table[form] = table.get(form, 0) | 1 << languages.index(lang)
    names = [f"_k{i}" for i in range(len(keys))]
    base = df.select(*[F.col(f"`{k}`").alias(n) for k, n in zip(keys, names, strict=True)], F.col(f"`{text}`").alias("_text"))
    if least is not None:
        base = base.filter(F.length("_text") >= least)
    types = dict(base.dtypes)

    of_whole = (*WHOLE, "text_statistics") if whole_too else WHOLE[:1]

    def count(texts: list[str]):  # noqa: ANN202
        return statistics(texts, table, len(languages)) if texts else (np.empty((0, len(STATISTICS))), np.empty((0, 3), np.int64), np.empty(0, np.int64))

    def run(batches):  # noqa: ANN001, ANN202
        import pyarrow as pa

        for given in batches:
            texts = given.column("_text").to_pylist()
            cores = [core(t) if t else "" for t in texts]
            contact = [not c.strip() and bool(t) and bool(t.replace("&nbsp;", " ").strip()) for t, c in zip(texts, cores, strict=True)]
            if least is not None:
                keep = [i for i, (t, c) in enumerate(zip(texts, cores, strict=True)) if len(t) >= least and c.strip()]
                given, texts, cores, contact = given.take(pa.array(keep, pa.int64())), [texts[i] for i in keep], [cores[i] for i in keep], [contact[i] for i in keep]
            wholes = [t.replace("&nbsp;", " ") if t else "" for t in texts]
            cores = [w if k else c for w, c, k in zip(wholes, cores, contact, strict=True)]
            seen = np.array([i for i, c in enumerate(cores) if c.strip()], np.int64)
            cut = [i for i in seen.tolist() if wholes[i] != cores[i]] if whole_too else []  # the whole of all others is their core
            values, counts, language = np.zeros((len(texts), len(STATISTICS))), np.zeros((len(texts), 3), np.int64), np.full(len(texts), -2)
            values[seen], counts[seen], language[seen] = count([cores[i] for i in seen.tolist()])
            whole, sizes = values.copy(), counts.copy()
            if cut:
                whole[cut], sizes[cut], _ = count([wholes[i] for i in cut])
            sizes[:, 0] = [len(t or "") for t in texts]
            null = np.array([t is None for t in texts], bool)
            arrays = [given.column(n) for n in names]
            arrays.append(pa.array([languages[k] if k >= 0 else default if k == -1 else None for k in language.tolist()], pa.string()))
            arrays.append(pa.array(contact, pa.bool_()))
            arrays += [pa.array(counts[:, k], pa.int64()) for k in range(3)]
            arrays += [pa.array(values[:, k], pa.float64()) for k in range(len(STATISTICS))]
            arrays += [pa.array(sizes[:, k], pa.int64(), mask=null) for k in range(3 if whole_too else 1)]
            if whole_too:
                arrays.append(_lists(whole, null))
            yield pa.RecordBatch.from_arrays(arrays, names=[*names, "language", "contact", *COUNTS, *STATISTICS, *of_whole])

    schema = ", ".join(f"{n} {types[n]}" for n in names) + ", language string, contact boolean, " + ", ".join(f"{c} bigint" for c in COUNTS) + ", " + ", ".join(f"{s} double" for s in STATISTICS) + ", " + ", ".join(f"{c} array<double>" if c == "text_statistics" else f"{c} bigint" for c in of_whole)
    return base.mapInArrow(run, schema).withColumnsRenamed(dict(zip(names, keys, strict=True)))


def _lists(values: np.ndarray, null: np.ndarray):  # noqa: ANN202
    """The rows of ``values`` as an Arrow array of lists, null where ``null``."""
    import pyarrow as pa

    ends = np.concatenate([[0], np.cumsum(~null)]) * values.shape[1]
    return pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(values[~null].reshape(-1), pa.float64()), mask=pa.array(null))


def _fold(word: str) -> str:
    return "".join(c for c in unicodedata.normalize("NFKD", word) if not unicodedata.combining(c))


#: A model: group to (mean, inverse covariance).
Model = dict[tuple[str, int], tuple[np.ndarray, np.ndarray]]
#: The group whose model serves groups without one: all texts together.
OTHER = ("", -1)
#: Smallest deviations of the statistics, so that one that hardly varies in prose does not decide alone.
FLOOR = np.array([0.08, 0.15, 0.02, 0.03, 0.10, 0.25, 0.12, 0.12, 0.04, 0.05, 0.06, 0.06, 0.04])


def _group(df: DataFrame) -> DataFrame:
    size = F.when(F.col("words") <= LENGTHS[0], 0).when(F.col("words") <= LENGTHS[1], 1).otherwise(2)
    return df.withColumn("_size", size)


def _distances(values: np.ndarray, model: tuple[np.ndarray, np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """(squared distances, contributions by statistic, which sum to them)."""
    off = values - model[0]
    parts = off * (off @ model[1])
    return parts.sum(axis=1), parts


def prose_model(stats: DataFrame, steps: int = 3, cutoff: float = 26.2, fewest: int = 100) -> Model:
    """Robust mean and covariance of every language and length class, over all rows of ``stats``.

    cutoff: squared distance up to which a text takes part in a step (the 0.985 quantile for 13 statistics). To each group
    ``fewest`` texts like the mean of all groups are added, so that a small group leans on the others. The driver receives one row of sums per group.
    """
    grouped = _group(stats)
    start: Model = {}
    median = grouped.groupBy("language", "_size").agg(F.count("*").alias("n"), *[F.percentile_approx(s, F.array(F.lit(0.25), F.lit(0.5), F.lit(0.75))).alias(s) for s in STATISTICS]).collect()
    for row in median:
        q = np.array([row[s] for s in STATISTICS], float)
        scale = np.maximum((q[:, 2] - q[:, 0]) / 1.349, FLOOR)
        start[row["language"], row["_size"]] = (q[:, 1], np.diag(1 / scale**2))
    model = start
    for step in range(steps):
        sums = _sums(grouped, model, cutoff * (3 if step == 0 else 1))
        fresh: Model = {}
        everything = np.sum([*sums.values()], axis=0) if sums else np.zeros(1)
        for g in model:
            if everything[0] < 2:
                fresh[g] = model[g]
                continue
            own = sums.get(g, 0) + everything * (fewest / everything[0])
            mean, covariance = _moments(own)
            fresh[g] = (mean, np.linalg.inv(covariance))
        model = fresh
    if model:
        mean, covariance = _moments(everything) if everything[0] >= 2 else (None, None)
        model[OTHER] = (mean, np.linalg.inv(covariance)) if mean is not None else model[min(model)]
    return model


def _moments(sums: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    d = len(STATISTICS)
    n, first, second = sums[0], sums[1 : 1 + d], sums[1 + d :].reshape(d, d)
    mean = first / n
    covariance = second / n - np.outer(mean, mean)
    scale = np.sqrt(np.maximum(np.diag(covariance), 1e-12))
    wide = np.maximum(scale, FLOOR)
    # correlations stay, deviations do not fall below the floor
    return mean, covariance / np.outer(scale, scale) * np.outer(wide, wide) * 0.9 + np.diag(wide**2) * 0.1


def _sums(grouped: DataFrame, model: Model, cutoff: float) -> dict[tuple[str, int], np.ndarray]:
    """Count, sums and sums of products of the rows within the cutoff, by group; added up in the tasks first."""
    d = len(STATISTICS)
    width = 1 + d + d * d

    def run(batches):  # noqa: ANN001, ANN202
        import pyarrow as pa

        total: dict[tuple[str, int], np.ndarray] = {}
        for given in batches:
            values = np.stack([given.column(s).to_numpy() for s in STATISTICS], axis=1)
            groups = np.array([f"{a}\t{b}" for a, b in zip(given.column("language").to_pylist(), given.column("_size").to_pylist(), strict=True)])
            for name in set(groups.tolist()):
                lang, size = name.split("\t")
                rows = values[groups == name]
                rows = rows[_distances(rows, model[lang, int(size)])[0] <= cutoff]
                sums = np.concatenate([[len(rows)], rows.sum(axis=0), (rows.T @ rows).reshape(-1)])
                total[lang, int(size)] = total.get((lang, int(size)), 0) + sums
        keys = [*total]
        place = pa.array(np.tile(np.arange(width), len(keys)), pa.int32())
        yield pa.RecordBatch.from_arrays([pa.array([k[0] for k in keys for _ in range(width)], pa.string()), pa.array([k[1] for k in keys for _ in range(width)], pa.int32()), place, pa.array(np.concatenate([total[k] for k in keys]) if keys else [], pa.float64())], names=["language", "_size", "place", "value"])

    parts = grouped.select("language", "_size", *STATISTICS).mapInArrow(run, "language string, _size int, place int, value double")
    out: dict[tuple[str, int], np.ndarray] = {}
    for row in parts.groupBy("language", "_size", "place").agg(F.sum("value").alias("value")).collect():
        out.setdefault((row["language"], row["_size"]), np.zeros(width))[row["place"]] = row["value"]
    return out


def outlierness(stats: DataFrame, model: Model) -> DataFrame:
    """``stats`` with ``distance`` and ``contributions`` (an array in the order of ``STATISTICS`` that sums to the distance).

    Both are null for texts without visible characters, which have no language, and under a model of no texts at all.
    """
    grouped = _group(stats)
    kinds = dict(grouped.dtypes)
    keep = [c for c in grouped.columns if c != "_size"]

    def run(batches):  # noqa: ANN001, ANN202
        import pyarrow as pa

        for given in batches:
            values = np.stack([given.column(s).to_numpy() for s in STATISTICS], axis=1)
            groups = [*zip(given.column("language").to_pylist(), given.column("_size").to_pylist(), strict=True)]
            distance, parts = np.zeros(len(groups)), np.zeros(values.shape)
            none = np.array([x[0] is None or not model for x in groups], bool)
            for g in set(groups):
                mine = np.array([x == g for x in groups]) & ~none
                if mine.any():
                    distance[mine], parts[mine] = _distances(values[mine], model.get(g) or model[OTHER])
            yield pa.RecordBatch.from_arrays([*[given.column(c) for c in keep], pa.array(distance, pa.float64(), mask=none), _lists(parts, none)], names=[*keep, "distance", "contributions"])

    return grouped.mapInArrow(run, ", ".join(f"`{c}` {kinds[c]}" for c in keep) + ", distance double, contributions array<double>")


def scored(df: DataFrame, keys: list[str], text: str, common: list[tuple[str, str]], default: str = "hu", least: int | None = 20, within: str | None = None, whole_too: bool = True) -> DataFrame:
    """Statistics, outlierness and contributions of every text of at least ``least`` characters (None: of every text), under one prose model.

    within: condition on the rows over which the model is estimated; all rows if None. whole_too: as in ``measured``.
    """
    stats = written(measured(df, keys, text, common, default, least, whole_too), "quality")
    return outlierness(stats, prose_model(stats.filter(within) if within else stats))
