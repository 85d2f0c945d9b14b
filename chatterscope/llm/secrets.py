"""Secrets in texts: known shapes, and strings that look random to character Markov models.

Two first-order models over ASCII characters, one of random strings and one of ordinary
identifiers, are trained from labelled samples. Random are the values that the known shapes
find, by alphabet, and stated strings of each alphabet, all alphabets weighted alike. Ordinary
are the words of a bounded sample of documents outside those finds, names put together from
such words, and stated numbers and dates; letters count without their case, cases and signs as
classes of their own. A long run of key characters is a secret if its log-likelihood ratio
is above a bar that held-out samples set. DataFrame functions only.
"""

from __future__ import annotations

import math
import random
from collections import Counter
from collections.abc import Iterable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from chatterscope.functions.binding import let
from chatterscope.llm.texts import fresh


@dataclass(frozen=True)
class Kind:
    """A shape: its pattern, the group that is the value, and the value's least length.

    ``needs`` are strings of which any match has at least one, a cheap test to begin with.
    """

    name: str
    pattern: str
    group: int
    least: int
    needs: tuple[str, ...] = ()


# The shapes to find (fixed values).
ASSIGN = Kind(
    "assign",
    r"""(?i:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
    1,
    12,
    ("=", ":"),
)
ACCESS = Kind("access", r"AKIA[A-Z0-9]+", 0, 18, ("AKIA",))
HEX = Kind("hex", r"[0-9a-f]{16,}", 0, 16)
BASE = (ASSIGN, ACCESS, HEX)
LEARNED = Kind("markov", r"[A-Za-z0-9+/_=-]{16,}", 0, 16)

WORD = Kind("word", r"[A-Za-z0-9+/_=-]{4,}", 0, 4)

# Alphabets of random strings; a value belongs to the first that has all its characters.
DIGITS, LOWER = "0123456789", "abcdefghijklmnopqrstuvwxyz"
UPPER = LOWER.upper()
ALPHABETS = {
    "hex": DIGITS + "abcdef",
    "upper hex": DIGITS + "ABCDEF",
    "base32": UPPER + "234567",
    "upper": UPPER + DIGITS,
    "base62": DIGITS + UPPER + LOWER,
    "base64": DIGITS + UPPER + LOWER + "+/",
    "url": DIGITS + UPPER + LOWER + "_-",
}
SMOOTHING = 0.5
# Stated random strings of an alphabet, their length, and names and numbers made; all by SEED.
STATED, STATED_LENGTH, SEED = 1000, 32, 11
MADE = 2000
#: Words of the sample from which names are put together, of smallest hash.
NAMED_FROM = 4000
#: Weight of a pair of letters' own count against those of its classes.
OWN_WEIGHT = 8.0
#: Share of letters that follow no pair of the sample.
FOREIGN = 0.25
#: Least log-likelihood ratio. The bar for each character is nearer to what random held-out
#: strings reach than to what ordinary ones do, but for these shares of either.
LEAST_RATIO = 8.0
FALSE_SHARE = 0.002
MISSED_SHARE = 0.01

SPAN = "array<struct<kind: string, rank: int, first: int, last: int, value: string>>"


def find(text: Column, kind: Kind, rank: int) -> Column:
    """Spans of all leftmost non-overlapping matches, in code points, the last one exclusive.

    The text between the matches gives their places: both come from the same pattern.
    """
    likely = F.lit(True)
    if kind.needs:
        likely = F.lit(False)
        for s in kind.needs:
            likely = likely | F.contains(text, F.lit(s))
    pattern = F.lit(kind.pattern)
    likely = F.when(likely, F.regexp_like(text, pattern)).otherwise(False)
    parts = F.arrays_zip(
        F.split(text, kind.pattern, -1).alias("gap"),
        F.regexp_extract_all(text, pattern, F.lit(0)).alias("all"),
        F.regexp_extract_all(text, pattern, F.lit(kind.group)).alias("value"),
    )
    start = F.struct(F.lit(0).alias("at"), F.array().cast(SPAN).alias("out"))

    def step(acc: Column, part: Column) -> Column:
        first = acc["at"] + F.char_length(part["gap"])
        last = first + F.char_length(part["all"])
        span = F.struct(
            F.lit(kind.name).alias("kind"),
            F.lit(rank).alias("rank"),
            first.alias("first"),
            last.alias("last"),
            part["value"].alias("value"),
        )
        long_enough = F.char_length(part["value"]) >= kind.least
        out = F.when(long_enough, F.concat(acc["out"], F.array(span))).otherwise(acc["out"])
        return F.struct(
            F.coalesce(last, first).alias("at"),
            F.when(part["all"].isNotNull(), out).otherwise(acc["out"]).alias("out"),
        )

    found = F.aggregate(parts, start, step, lambda acc: acc["out"])
    return F.when(likely, found).otherwise(F.array().cast(SPAN))


def base_spans(text: Column) -> Column:
    """Spans of the known shapes by start, then kind as listed; a null text is empty."""
    whole = F.coalesce(text, F.lit(""))
    found = F.concat(*[find(whole, kind, rank) for rank, kind in enumerate(BASE)])
    return ordered(found)


def ordered(spans: Column) -> Column:
    def by_place(a: Column, b: Column) -> Column:
        return F.coalesce(
            F.nullif(a["first"] - b["first"], F.lit(0)),
            F.nullif(a["rank"] - b["rank"], F.lit(0)),
            a["last"] - b["last"],
        )

    return F.when(F.size(spans) > 1, F.array_sort(spans, by_place)).otherwise(spans)


def words_outside(text: Column, base: Column, kind: Kind) -> Column:
    """Runs of key characters that touch none of the ``base`` spans."""
    found = find(F.coalesce(text, F.lit("")), kind, len(BASE))
    return let(
        base,
        lambda known: F.filter(
            found,
            lambda s: ~F.exists(
                known, lambda b: (b["first"] < s["last"]) & (s["first"] < b["last"])
            ),
        ),
    )


ALPHABET = 128


def transitions(value: Column) -> Column:
    """The code of each pair of neighbouring characters, a line break standing before the first."""
    codes = F.transform(F.split(value, ""), lambda c: F.least(F.ascii(c), F.lit(ALPHABET - 1)))
    return let(
        F.filter(codes, lambda c: c > 0),
        lambda c: F.transform(
            c, lambda x, i: F.when(i > 0, F.get(c, i - 1)).otherwise(F.lit(10)) * ALPHABET + x
        ),
    )


@dataclass(frozen=True)
class Model:
    """Log-likelihood ratio, random against ordinary, of each pair of characters, and the bar."""

    ratios: tuple[float, ...]
    per_character: float

    def ratio(self, value: Column) -> Column:
        # One constant: an array literal would be an expression for each number.
        numbers = ",".join(map(str, self.ratios))
        table = F.split(F.lit(numbers), ",").cast("array<double>")
        return F.aggregate(
            transitions(value), F.lit(0.0), lambda acc, p: acc + F.get(table, p)
        )

    def ratio_of(self, value: str) -> float:
        """``ratio`` of one string on the driver."""
        return sum(self.ratios[p] for p in pairs(value))


def pairs(value: str) -> list[int]:
    """``transitions`` of one string."""
    codes = [10, *(min(ord(c), ALPHABET - 1) for c in value)]
    return [a * ALPHABET + b for a, b in zip(codes, codes[1:])]


def stated_random(seed: int = SEED) -> dict[str, list[str]]:
    """The stated strings of each alphabet."""
    rng = random.Random(seed)
    return {
        name: ["".join(rng.choices(letters, k=STATED_LENGTH)) for _ in range(STATED)]
        for name, letters in ALPHABETS.items()
    }


def stated_ordinary(words: list[str], seed: int = SEED) -> list[str]:
    """Names put together from ``words`` in the usual ways, numbers, dates, times and rules."""
    rng = random.Random(seed)
    out = []
    letters = [w for w in words if w.isalpha()] or ["name", "value"]
    for _ in range(MADE):
        some = [w.lower() for w in rng.choices(letters, k=rng.randint(2, 4))]
        number = str(rng.randint(0, 99))
        way = rng.randrange(8)
        if way < 3:
            out.append("_-/"[way].join([*some, *[number] * (rng.random() < 0.2)]))
        elif way == 3:
            out.append("_".join(some).upper())
        elif way == 4:
            out.append(some[0] + "".join(w.capitalize() for w in some[1:]))
        elif way == 5:
            out.append("".join(w.capitalize() for w in some))
        elif way == 6:
            out.append("".join(some) + number * (rng.random() < 0.2))
        else:
            out.append("".join(some).upper())
    for _ in range(MADE // 2):
        date = f"{rng.randint(1950, 2050)}-{rng.randint(1, 12):02}-{rng.randint(1, 28):02}"
        clock = f"{rng.randint(0, 23):02}-{rng.randint(0, 59):02}-{rng.randint(0, 59):02}"
        run = "".join(rng.choices(DIGITS, k=rng.randint(16, 32)))
        parted = "-".join("".join(rng.choices(DIGITS, k=rng.randint(2, 5))) for _ in range(5))
        stamp = f"{date}T{clock}-{rng.randint(0, 999):03}"
        out += [run, parted, stamp, date.replace("-", "/") + "/" + clock, rng.choice("-=_+/") * rng.randint(16, 60)]
    return out


def alphabet_of(value: Column) -> Column:
    """The first alphabet that has all characters of ``value``, null where none has."""
    found = F.lit(None).cast("string")
    for name, letters in reversed(ALPHABETS.items()):
        found = F.when(F.translate(value, letters, "") == "", name).otherwise(found)
    return found


def train(documents: DataFrame, sample_docs: int = 5000) -> Model | None:
    """Learn from (doc_id, text); None where the sample has no word.

    Random strings are the values of the known shapes of the whole table, counted by alphabet,
    and the stated ones. Ordinary are the words of about ``sample_docs`` documents, a hash
    range of ids, and the stated ones. Of the sample, long words with an odd hash are held out:
    they and stated strings of another seed set the bar.
    """
    shapes = documents.select(F.explode(base_spans(F.col("text"))).alias("s")).select(
        alphabet_of(F.col("s.value")).alias("kind"), F.col("s.value").alias("value")
    )
    share = min(1.0, sample_docs / max(1, documents.count()))
    key = F.xxhash64(F.coalesce(F.col("doc_id").cast("string"), F.lit("")))
    sample = documents.filter(F.pmod(key, F.lit(1 << 30)) <= int(share * (1 << 30)))
    words = (
        sample.select("text", base_spans(F.col("text")).alias("base"))
        .select(F.explode(words_outside(F.col("text"), F.col("base"), WORD)).alias("s"))
        .groupBy(F.col("s.value").alias("value"))
        .agg(F.count("*").alias("n"))
    )
    # Words of the bounded sample; the longest repeat least, so each counts once.
    words = words.select(
        "value", (F.pmod(F.xxhash64("value"), F.lit(2)) == 1).alias("odd"), F.xxhash64("value").alias("h")
    ).cache()
    held_out = F.col("odd") & (F.char_length("value") >= LEARNED.least)
    counted = (
        shapes.filter("kind IS NOT NULL")
        .unionAll(words.filter(~held_out).select(F.lit("").alias("kind"), "value"))
        .select("kind", F.explode(transitions(F.col("value"))).alias("pair"))
        .groupBy("kind", "pair")
        .agg(F.count("*").alias("n"))
        .collect()  # one row per pair of characters and alphabet at most
    )
    named = [r["value"] for r in words.filter("not odd").orderBy("h", "value").limit(NAMED_FROM).collect()]
    unseen = [r["value"] for r in words.filter(held_out).orderBy("h", "value").limit(NAMED_FROM).collect()]
    others = [r["value"] for r in words.filter("odd").orderBy("h", "value").limit(NAMED_FROM).collect()]
    words.unpersist()
    counts = {name: Counter() for name in ("", *ALPHABETS)}
    for r in counted:
        counts[r["kind"]][r["pair"]] += r["n"]
    if not counts[""]:
        return None
    for name, strings in stated_random().items():
        counts[name].update(p for s in strings for p in pairs(s))
    # As much weight for names and numbers as for the words of the sample.
    stated = Counter(p for s in stated_ordinary(named) for p in pairs(s))
    weight = max(1, counts[""].total() // stated.total())
    counts[""].update({p: n * weight for p, n in stated.items()})
    ratios = ratios_of(counts)
    strange = [s for strings in stated_random(SEED + 1).values() for s in strings]
    return Model(ratios, bar_of(ratios, unseen + stated_ordinary(others, SEED + 1), strange))


def bar_of(ratios: tuple[float, ...], ordinary: Iterable[str], strange: Iterable[str]) -> float:
    """The ratio per character, two thirds of the way from most ordinary to most random strings."""
    known = Model(ratios, 0.0)

    def reached(strings: Iterable[str], share: float) -> float:
        each = sorted(known.ratio_of(s) / len(s) for s in strings)
        return each[min(int(len(each) * share), len(each) - 1)]

    high = reached((s for s in ordinary if len(s) >= LEARNED.least), 1 - FALSE_SHARE)
    low = reached((s[: LEARNED.least] for s in strange), MISSED_SHARE)
    return round((high + 2 * low) / 3, 6)


def character_class(code: int) -> str:
    c = chr(code)
    return "l" if c in LOWER else "u" if c in UPPER else "d" if c in DIGITS else c


def ratios_of(counts: dict[str, Counter]) -> tuple[float, ...]:
    """The log ratio of each pair of characters; ``counts[""]`` are the ordinary ones.

    The share of a pair among ordinary strings is that of its classes times that of its
    letters without case, and its own share where it is frequent. The shares among random
    strings are those of all alphabets, weighted alike.
    """
    codes = [10, *(ord(c) for c in DIGITS + UPPER + LOWER + "+/_=-")]
    classes = {c: character_class(c) for c in codes}
    folded = {c: ord(chr(c).lower()) for c in codes}
    n_classes = len(set(classes.values()))
    own, by_class, by_letter = Counter(), Counter(), Counter()
    before, class_before, letter_before = Counter(), Counter(), Counter()
    alike = Counter()
    for pair, n in counts[""].items():
        a, b = divmod(pair, ALPHABET)
        if a not in classes or b not in classes:
            continue
        own[a, b] += n
        before[a] += n
        by_class[classes[a], classes[b]] += n
        class_before[classes[a]] += n
        kind = "w" if classes[b] in "lu" else classes[b]
        by_letter[folded[a], folded[b]] += n
        letter_before[folded[a], kind] += n
    for c in codes[1:]:
        alike["w" if classes[c] in "lu" else classes[c]] += 0.5 if classes[c] in "lu" else 1
    random_share = Counter()
    random_before = Counter()
    for name, letters in ALPHABETS.items():
        total = sum(counts[name].values()) + SMOOTHING * len(letters)
        for a in (10, *map(ord, letters)):
            for b in map(ord, letters):
                n = (counts[name][a * ALPHABET + b] + SMOOTHING / len(letters)) / total
                random_share[a, b] += n
                random_before[a] += n
    out = [0.0] * (ALPHABET * ALPHABET)
    for a in codes:
        for b in codes[1:]:
            kind = "w" if classes[b] in "lu" else classes[b]
            of_class = (by_class[classes[a], classes[b]] + SMOOTHING) / (
                class_before[classes[a]] + SMOOTHING * n_classes
            )
            of_letter = (by_letter[folded[a], folded[b]] + SMOOTHING) / (
                letter_before[folded[a], kind] + SMOOTHING * alike[kind]
            )
            # Words of another field have other letters than the sample's.
            of_letter = (1 - FOREIGN) * of_letter + FOREIGN / alike[kind]
            backed = of_class * of_letter
            ordinary = (own[a, b] + OWN_WEIGHT * backed) / (before[a] + OWN_WEIGHT)
            share = (random_share[a, b] + 1e-7) / (random_before[a] + 1e-7 * len(codes))
            out[a * ALPHABET + b] = round(math.log(share) - math.log(ordinary), 6)
    return tuple(out)


def secrets_of(text: Column, base: Column, model: Model | None) -> Column:
    """The ``base`` spans and the long words that the model takes for random, by start."""
    if model is None:
        return base

    def is_random(s: Column) -> Column:
        return let(
            model.ratio(s["value"]),
            lambda r: (r >= LEAST_RATIO) & (r >= model.per_character * F.char_length(s["value"])),
        )

    return ordered(F.concat(base, F.filter(words_outside(text, base, LEARNED), is_random)))


def scan(
    documents: DataFrame, model: Model | None, keep: tuple[str, ...] = ("doc_id",)
) -> DataFrame:
    """The columns ``keep``, then ``base`` and ``secrets``: arrays of spans of each whole text.

    ``base`` has the known shapes, ``secrets`` these and what the model adds, by start. A span
    is (kind, rank, first, last, value). Null and empty texts have none, repeated rows have
    the same, an empty table gives no rows. Without a model only the known shapes are found.
    Where a kept column is called base or secrets, the result's name has an underscore more.
    """
    text, base, found = (fresh(n, [*documents.columns]) for n in ("_text", "_base", "_secrets"))
    rows = documents.select(*keep, F.col("text").alias(text))
    rows = rows.select(*keep, text, base_spans(F.col(text)).alias(base))
    return rows.select(
        *keep,
        F.col(base).alias(fresh("base", list(keep))),
        secrets_of(F.col(text), F.col(base), model).alias(fresh("secrets", list(keep))),
    )


def listed(spans: Column) -> Column:
    """kind:first:last of each span, comma-joined."""
    return F.array_join(
        F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["first"], s["last"])), ","
    )


def redact(
    documents: DataFrame, model: Model | None, text: str = "text", mark: str = "[secret]"
) -> DataFrame:
    """The documents with the value of each secret replaced by ``mark``; a null text stays null.

    Spans that overlap are replaced as one. All columns stay as they are.
    """
    base, found, was = (fresh(n, documents.columns) for n in ("_base", "_secrets", "_was"))
    whole = F.coalesce(F.col(was), F.lit(""))
    rows = documents.withColumn(was, F.col(text)).withColumn(base, base_spans(F.col(was)))
    rows = rows.withColumn(found, secrets_of(F.col(was), F.col(base), model))
    start = F.struct(F.lit(0).alias("at"), F.lit("").alias("out"))

    def step(acc: Column, s: Column) -> Column:
        # The value is the end of its span.
        first = s["last"] - F.char_length(s["value"])
        before = F.substring(whole, acc["at"] + 1, F.greatest(first - acc["at"], F.lit(0)))
        marked = F.when(first >= acc["at"], F.concat(acc["out"], before, F.lit(mark)))
        return F.struct(
            F.greatest(acc["at"], s["last"]).alias("at"),
            marked.otherwise(acc["out"]).alias("out"),
        )

    clean = F.aggregate(
        F.col(found),
        start,
        step,
        lambda acc: F.concat(acc["out"], F.substring(whole, acc["at"] + 1, F.char_length(whole))),
    )
    replaced = F.when(F.size(found) > 0, clean).otherwise(F.col(was))
    return rows.withColumn(text, replaced).select(*documents.columns)
