"""Spelling variants: words one edit apart, grouped under the far more frequent form.

Candidates come from asymmetric chunks. Of two near words the shorter one (or either, where they are equally long) is cut in two
disjoint chunks; one edit leaves one of them whole, and the other word holds it as a positional gram shifted by at most one. So a
pair meets on the chunk that is left, and the edit lies in the rest of the shorter word. Where many words meet on one chunk, the
rest is cut in two again, so that the words meet on more letters, until few meet or the rest is a single letter; then every word
of the bucket differs in that place alone, and an alphabet bounds it. No bucket is capped and no pair is lost.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Fixed values of the counting rule.
RUN = "[A-Za-zÀ-ÿ]+"
DROP = 199  # a run's letter is deleted where this divides its hash
MIN_LENGTH, MIN_COUNT, RATIO = 6, 5, 5

BUCKET_PAIRS = 256  # pairs that may meet on one key before the words' rests are cut again

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def runs(docs: DataFrame) -> DataFrame:
    """(word) of each run of letters in ``docs`` (doc_id, text), lower-cased, one letter deleted where the rule says so."""
    run = F.explode(F.regexp_extract_all(F.translate("text", UPPER, LOWER), F.lit(RUN), F.lit(0)))
    found = docs.select(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).alias("id"), run.alias("run"))
    # runs that stay too short whatever happens to them need no hash
    found = found.where(F.length("run") >= MIN_LENGTH)
    h = F.crc32(F.concat(F.col("id"), F.lit(":"), F.col("run")).cast("binary"))
    at = (h % F.length("run")).cast("int")
    less = F.concat(F.substring("run", F.lit(1), at), F.substr("run", at + 2))
    return found.select(F.when(h % DROP == 0, less).otherwise(F.col("run")).alias("word"))


def count_words(docs: DataFrame) -> DataFrame:
    """(word, n) of words long and frequent enough; counted before the shuffle."""
    counted = runs(docs).where(F.length("word") >= MIN_LENGTH).groupBy("word").agg(F.count("*").alias("n"))
    return counted.where(F.col("n") >= MIN_COUNT)


def _cut(word: Column, start: Column, end: Column) -> Column:
    """Letters from place ``start`` up to ``end``, places from 0."""
    return F.substr(word, start + 1, end - start)


def _key(word: Column, length: Column, low: Column, high: Column, shift: Column) -> Column:
    """What two words must share when the edit lies in [low, high) of the shorter one, which has ``length`` letters.

    ``shift`` is 1 for a word that is one letter longer: what follows the edit is shifted in it.
    """
    return F.xxhash64(length, low, high, _cut(word, F.lit(0), low), _cut(word, high + shift, length + shift))


def _halves(rows: DataFrame) -> DataFrame:
    """Each row's rest [low, high) cut in two: the edit is in the one or in the other."""
    middle = F.expr("low + (high - low) div 2")
    rest = F.array(F.struct(F.col("low"), middle.alias("high")), F.struct(middle.alias("low"), F.col("high")))
    rows = rows.withColumn("rest", F.explode(rest)).withColumn("low", F.col("rest.low")).withColumn("high", F.col("rest.high"))
    return rows.withColumn("key", _key(F.col("word"), F.col("length"), F.col("low"), F.col("high"), F.col("shift"))).drop("rest")


def near_pairs(words: DataFrame, area) -> DataFrame:
    """(a, b) of all pairs of ``words`` (word) that one inserted, deleted or replaced letter sets apart.

    ``a`` is the shorter one, or the lesser of equally long ones.
    """
    size = F.length("word")
    # a word meets words of its own length, and as the longer one those with a letter less
    sides = F.array(*[F.struct((size - shift).alias("length"), F.lit(shift).alias("shift")) for shift in (0, 1)])
    rows = words.select("word", F.inline(sides)).withColumn("low", F.lit(0)).withColumn("high", F.col("length"))
    found, level = [], 0
    while True:
        rows = area.table(_halves(rows), f"variants_keys{level}")
        # one row per key, counted before the shuffle
        keys = rows.groupBy("key").agg(F.count_if(F.col("shift") == 0).alias("short"), F.count_if(F.col("shift") == 1).alias("long"))
        keys = keys.where("short > 0 and short + long > 1").select("key", (F.col("short") * (F.col("short") + F.col("long"))).alias("pairs"))
        met = area.table(rows.join(keys, "key"), f"variants_met{level}")
        again = (F.col("pairs") > BUCKET_PAIRS) & (F.col("high") - F.col("low") > 1)
        few = met.where(~again)
        side = lambda s: few.select("key", F.col("word").alias(s), F.col("shift").alias(f"shift_{s}"))
        pairs = side("a").where("shift_a = 0").join(side("b"), "key").where("shift_b = 1 or a < b")
        pairs = pairs.where((F.levenshtein("a", "b", 1) == 1) & (F.length("b") - F.length("a") == F.col("shift_b")))
        found.append(area.table(pairs.select("a", "b"), f"variants_pairs{level}"))
        rows = met.where(again).select("word", "length", "shift", "low", "high")
        if rows.limit(1).count() == 0:
            break
        level += 1
    pairs = found[0]
    for more in found[1:]:
        pairs = pairs.unionByName(more)
    # a letter next to its like may be the inserted one in either half
    return pairs.distinct()


def roots_of(forms: DataFrame, area) -> DataFrame:
    """(word, root): where following ``forms`` (word, form) ends.

    Each round doubles the steps taken. A form is RATIO times as frequent as its word, so there are no circles and the rounds are few.
    """
    steps, turn = area.table(forms.select("word", F.col("form").alias("root")), "variants_roots0"), 0
    while True:
        turn += 1
        further = steps.select(F.col("word").alias("root"), F.col("root").alias("next"))
        moved = steps.join(further, "root", "left").select("word", F.coalesce("next", "root").alias("root"), F.col("next").isNotNull().alias("moved"))
        moved = area.table(moved, f"variants_roots{turn}")
        steps = moved.select("word", "root")
        if moved.where("moved").limit(1).count() == 0:
            return steps


def group_variants(docs: DataFrame, area) -> DataFrame:
    """(word, form, root, n, n_near, form_n) of each frequent word of ``docs`` (doc_id, text).

    Null and empty texts have no words; a null doc_id is spelled as nothing in the hash. Rows that repeat an id count each. Texts of
    any length are read whole. Equally frequent near words: the lesser by code points is the form. Other columns are ignored; an
    empty table gives an empty result.
    """
    words = area.table(count_words(docs), "variants_words")
    pairs = area.table(near_pairs(words.select("word"), area), "variants_pairs")
    both = pairs.select(F.col("a").alias("word"), F.col("b").alias("near")).unionByName(pairs.select(F.col("b").alias("word"), F.col("a").alias("near")))
    counted = both.join(words.select(F.col("word").alias("near"), F.col("n").alias("near_n")), "near")
    best = counted.groupBy("word").agg(F.count("*").alias("n_near"), F.min(F.struct((-F.col("near_n")).alias("less"), "near")).alias("best"))
    judged = words.join(best, "word", "left").withColumn("fits", -F.col("best.less") >= RATIO * F.col("n"))
    judged = judged.select("word", "n", F.coalesce("n_near", F.lit(0)).cast("bigint").alias("n_near"), F.when(F.col("fits"), F.col("best.near")).alias("form"),
                           F.when(F.col("fits"), -F.col("best.less")).alias("form_n"))
    judged = area.table(judged, "variants_judged")
    roots = roots_of(judged.where("form is not null"), area)
    return judged.join(roots, "word", "left").select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")
