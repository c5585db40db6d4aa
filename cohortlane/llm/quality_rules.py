"""Quality rules: a threshold table compiled into one projection of built-in functions.

``quality_metrics`` computes counts of each text, ``compile_rules`` turns a table of thresholds into one boolean
column, and ``quality_rules`` joins both. Nothing leaves the row, so the work needs no shuffle, and nothing but built-in
functions runs. A null text counts as empty: it has no words and is rejected. Repeated rows are judged each on its own;
an empty table gives an empty result. Extra columns are ignored; only ``doc_id`` and ``text`` are read.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

#: Bytes 0x09 to 0x0D and the blank part words.
SEPARATORS = " \t\n\x0b\x0c\r"
SEPARATOR_PATTERN = "[\\x20\\x09-\\x0D]+"
SYMBOLS = "#*$%&|<>"
WINDOW = 8

#: Frequent function words of English, French, German and Spanish.
STOP_WORDS = (
    "the of and to in that is was for with as by on this are be "
    "de la le les et des en un une du que est pour qui dans par pas sur au ne "
    "der die und den von zu das mit sich auf für ist im dem nicht ein eine "
    "el los se del las por con no su para es al lo y a"
).split()


@dataclass(frozen=True)
class Threshold:
    """``100 * numerator`` must lie between ``least`` and ``most`` times ``denominator`` (both in per cent)."""

    name: str
    numerator: str
    denominator: str | None
    least: int | None = None
    most: int | None = None

    def column(self) -> Column:
        part = F.col(self.numerator) * (1 if self.denominator is None else 100)
        whole = F.lit(1) if self.denominator is None else F.col(self.denominator)
        checks = []
        if self.least is not None:
            checks.append(part >= whole * self.least)
        if self.most is not None:
            checks.append(part <= whole * self.most)
        return reduce(lambda a, b: a & b, checks, F.lit(True))

    def sql(self) -> str:
        part = self.numerator if self.denominator is None else f"100 * {self.numerator}"
        whole = "1" if self.denominator is None else self.denominator
        checks = [f"{part} >= {whole} * {self.least}"] if self.least is not None else []
        checks += [f"{part} <= {whole} * {self.most}"] if self.most is not None else []
        return "(" + " and ".join(checks or ["true"]) + ")"


#: The base of the contract: these fail a document whatever the table says.
BASE = (
    Threshold("length", "n_words", None, least=20),
    Threshold("repeated windows", "n_repeat_words", "n_words", most=30),
)
#: The table of the production query.
RULES = (
    Threshold("mean word length", "word_chars", "n_words", least=200, most=1500),
    Threshold("symbols per word", "n_symbols", "n_words", most=10),
    Threshold("repeated lines", "n_dup_lines", "n_lines", most=40),
    Threshold("stop words", "n_stop_words", "n_words", least=5),
)


def quality_metrics(docs: DataFrame) -> DataFrame:
    """Per row: doc_id, n_words, word_chars, n_symbols, n_lines, n_dup_lines, n_stop_words, n_repeat_words (all long).

    ``n_repeat_words`` counts the words inside some window of eight words that the text holds twice or more. Windows
    are first compared by hash; only texts in which a hash repeats are sorted, with the windows themselves as keys.
    """
    text = F.coalesce(F.col("text"), F.lit(""))
    bare = lambda column: F.length(F.translate(column, SEPARATORS, ""))
    parts = docs.select(
        "doc_id",
        F.array_remove(F.split(text, SEPARATOR_PATTERN), "").alias("words"),
        bare(text).alias("word_chars"),
        (F.length(text) - F.length(F.translate(text, SYMBOLS, ""))).alias("n_symbols"),
        F.filter(F.split(text, "\n", -1), lambda line: bare(line) > 0).alias("lines"),
    )
    n_words = F.size("words")
    starts = F.sequence(F.lit(1), n_words - (WINDOW - 1))
    hashed = parts.select(
        "doc_id", "word_chars", "n_symbols", "words",
        n_words.alias("n_words"),
        F.size("lines").alias("n_lines"),
        (F.size("lines") - F.size(F.array_distinct("lines"))).alias("n_dup_lines"),
        F.size(F.filter("words", lambda w: F.lower(w).isin(STOP_WORDS))).alias("n_stop_words"),
        F.when(n_words > WINDOW, F.transform(starts, lambda i: F.xxhash64(F.slice("words", i, WINDOW))))
        .alias("hashes"),
    )
    repeats = F.size(F.array_distinct("hashes")) < F.size("hashes")
    kept = [c for c in hashed.columns if c not in ("words", "hashes")]
    ordered = hashed.select(*kept, F.when(repeats, F.sort_array(F.transform(
        F.sequence(F.lit(1), F.size("hashes")),
        lambda i: F.struct(
            F.element_at("hashes", i).alias("h"), F.slice("words", i, WINDOW).alias("w"), i.alias("i"),
        ),
    ))).alias("windows"))

    def equal(j: Column, k: Column) -> Column:
        a, b = F.get("windows", j), F.get("windows", k)
        return F.coalesce((a["h"] == b["h"]) & (a["w"] == b["w"]), F.lit(False))

    found = ordered.select(*kept, F.sort_array(F.filter(F.transform(
        F.sequence(F.lit(0), F.size("windows") - 1),
        lambda j: F.when(equal(j, j - 1) | equal(j, j + 1), F.get("windows", j)["i"]),
    ), lambda i: i.isNotNull())).alias("starts"))
    gaps = F.zip_with(
        "starts", F.slice("starts", 2, F.size("starts")),
        lambda here, following: F.least(F.coalesce(following - here, F.lit(WINDOW)), F.lit(WINDOW)),
    )
    covered = F.when(F.size("starts") > 0, F.aggregate(gaps, F.lit(0), lambda total, gap: total + gap))
    counts = found.select(*kept, F.coalesce(covered, F.lit(0)).alias("n_repeat_words"))
    metrics = F.struct("doc_id", *[F.col(c).cast("long").alias(c) for c in counts.columns if c != "doc_id"])
    # A filter on a metric stops above this generator. Pushed further, it would hold the intermediates written out
    # inside each other's lambdas, computed again for every element.
    return counts.select(F.explode(F.array(metrics)).alias("m")).select("m.*")


def compile_rules(rules: tuple[Threshold, ...]) -> Column:
    """One boolean column: true if every threshold holds."""
    return reduce(lambda a, b: a & b, [rule.column() for rule in rules], F.lit(True))


def quality_rules(docs: DataFrame, rules: tuple[Threshold, ...] = RULES) -> DataFrame:
    """The metrics with ``base_failed`` and ``kept``."""
    judged = quality_metrics(docs).withColumn("base_failed", ~compile_rules(BASE))
    return judged.withColumn("kept", ~F.col("base_failed") & compile_rules(rules))


def keep_good(docs: DataFrame, rules: tuple[Threshold, ...] = RULES) -> DataFrame:
    """The documents that pass, with their own columns and no shuffle.

    The row is packed beside its metrics, so clashing column names do no harm.
    """
    packed = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("doc_id"), "text")
    return quality_rules(packed, rules).filter("kept").select("doc_id.*")


def oracle(rules: tuple[Threshold, ...] = RULES) -> str:
    """DuckDB SQL for the result of ``quality_rules`` over ``documents``."""
    stop = ", ".join(f"'{w}'" for w in STOP_WORDS)
    return f"""
with t as (select doc_id, coalesce(text, '') as text from documents),
w as (select doc_id, text, regexp_extract_all(text, '[^\\x20\\x09-\\x0D]+') as words,
      list_filter(string_split(text, chr(10)), lambda l: regexp_matches(l, '[^\\x20\\x09-\\x0D]')) as lines from t),
g as (select doc_id, i, array_to_string(words[i:i + 7], ' ') as gram
      from (select doc_id, words, unnest(range(1, len(words) - 6)) as i from w)),
r as (select doc_id, i from g qualify count(*) over (partition by doc_id, gram) > 1),
c as (select doc_id, cast(sum(least(8, coalesce(n - i, 8))) as bigint) as n_repeat_words
      from (select doc_id, i, lead(i) over (partition by doc_id order by i) as n from r) group by doc_id),
m as (select w.doc_id, cast(len(words) as bigint) as n_words,
      cast(length(regexp_replace(text, '[\\x20\\x09-\\x0D]', '', 'g')) as bigint) as word_chars,
      cast(length(text) - length(regexp_replace(text, '[#*$%&|<>]', '', 'g')) as bigint) as n_symbols,
      cast(len(lines) as bigint) as n_lines,
      cast(len(lines) - len(list_distinct(lines)) as bigint) as n_dup_lines,
      cast(len(list_filter(words, lambda x: lower(x) in ({stop}))) as bigint) as n_stop_words,
      coalesce(c.n_repeat_words, 0) as n_repeat_words
      from w left join c on c.doc_id = w.doc_id)
select *, not ({' and '.join(r.sql() for r in BASE)}) as base_failed,
  {' and '.join(r.sql() for r in (*BASE, *rules))} as kept
from m"""
