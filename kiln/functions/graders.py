"""Answer extraction and grading as Column expressions.

All of them run as JVM expressions; so do the LaTeX rules and the grade of
``kiln.functions.math_grade`` (G7-G11), where only the brace count of G1 is an
Arrow UDF.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# ---- fixed values ----
# ASCII punctuation (Python string.punctuation) as a regex class.
PUNCT_CLASS = r"[!-/:-@\[-`{-~]"
ARTICLES = r"(?U)\b(a|an|the)\b"
# ---- end of fixed values ----


def pystrip(c: Column) -> Column:
    return F.regexp_replace(c, r"(?U)^\s+|\s+$", "")


def gsm8k_answer(text: Column) -> Column:
    """Last line whose stripped text starts with ``####``.

    Its tail is stripped, a leading ``:`` dropped and commas removed. Else the
    last ``####\\s*(.+)`` match (commas kept; ``\\s*`` may cross a line, T14).
    """
    lines = F.transform(F.split(text, r"\r\n|\r|\n"), lambda l: pystrip(l))
    last = F.try_element_at(F.filter(lines, lambda l: l.startswith("####")), F.lit(-1))
    tail = pystrip(F.substring(last, 5, 1 << 30))
    tail = pystrip(F.when(tail.startswith(":"), F.substring(tail, 2, 1 << 30)).otherwise(tail))
    primary = pystrip(F.replace(tail, F.lit(","), F.lit("")))
    fallback = pystrip(F.try_element_at(F.regexp_extract_all(text, F.lit(r"####\s*(.+)"), 1), F.lit(-1)))
    return F.coalesce(primary, fallback)


def answer_after_marker(text: Column, marker: str = "Answer:") -> Column:
    """Text after the marker when it occurs exactly once (stripped), else null."""
    n = (F.length(text) - F.length(F.replace(text, F.lit(marker), F.lit("")))) / len(marker)
    return F.when(n == 1, pystrip(F.substring_index(text, marker, -1)))


def final_answer_word(text: Column) -> Column:
    """First ``Final Answer: (\\w+)`` capture, null if none."""
    return F.nullif(F.regexp_extract(text, r"(?U)Final Answer: (\w+)", 1), F.lit(""))


def qa_normalize(s: Column) -> Column:
    """Lower → drop ASCII punctuation → articles to space → collapse whitespace."""
    x = F.lower(s)
    x = F.regexp_replace(x, PUNCT_CLASS, "")
    x = F.regexp_replace(x, ARTICLES, " ")
    return pystrip(F.regexp_replace(x, r"(?U)\s+", " "))


def exact_match_any(pred: Column, golds: Column) -> Column:
    """Normalised prediction equals any normalised gold; no prediction or golds → false."""
    p = qa_normalize(pred)
    return F.coalesce(
        F.when(pred.isNotNull() & (F.size(golds) > 0), F.exists(golds, lambda g: qa_normalize(g) == p)),
        F.lit(False),
    )


def format_reward(correct: Column, format_ok: Column, format_coef: float = 0.1) -> Column:
    """``coef · (format − 1) + correct``."""
    return F.lit(format_coef) * (format_ok.cast("double") - 1.0) + correct.cast("double")


def sum_check(text: Column, x: Column, y: Column) -> Column:
    """First whitespace token as an integer equals x + y (unparsable → false)."""
    first = F.element_at(F.split(pystrip(text), r"\s+"), 1)
    return F.coalesce(first.try_cast("long") == (x + y), F.lit(False))


def contains_ci(response: Column, target: Column) -> Column:
    """Case-insensitive containment."""
    return F.contains(F.lower(response), F.lower(target))


def guess_value(text: Column) -> Column:
    """Text after ``Guess: `` at the start of the reply."""
    return F.when(text.rlike(r"^Guess: "), F.regexp_extract(text, r"^Guess: (.*)", 1))


def number_guess_reward(text: Column, secret: Column) -> Column:
    """Correct 1, too low / too high 0, unparsable −1."""
    g = guess_value(text).try_cast("long")
    return F.when(g.isNull(), F.lit(-1.0)).when(g == secret, F.lit(1.0)).otherwise(F.lit(0.0))


def word_guess_reward(text: Column, word: Column) -> Column:
    """Case-insensitive equality of the guess with the secret word."""
    return F.coalesce((F.lower(guess_value(text)) == F.lower(word)).cast("double"), F.lit(0.0))


def shorter_preference(len_a: Column, len_b: Column) -> Column:
    """A longer → +1 (B preferred), B longer → −1, tie 0."""
    return F.signum(len_a - len_b)


def label_score(label: Column) -> Column:
    """A → −1, B → +1, Tie / anything else → 0."""
    return F.when(label == "A", -1.0).when(label == "B", 1.0).otherwise(0.0)
