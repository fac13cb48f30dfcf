"""Line-first quality rules, in DataFrame functions only.

Every line of a text is judged by itself: does it look like prose (punctuation: a short line ends like a sentence, a
long one has some sign in it), like a row of links (navigation) or like site text (boilerplate)? Lines that fail are removed. A document that loses more
than ``max_loss`` of its words, or fails the base rule on words and repetition, is rejected.

Defined results: a null or empty text has no words and fails the base rule; text without words on any
line keeps no line; texts of any length are read whole; equal rows are judged alike; an empty table gives an empty
result; other columns pass through unchanged. The names of helper columns avoid those of the input.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .staging import fresh

# Fixed values of the contract: white space, symbol characters, base thresholds.
WHITE = r"[\x20\x09-\x0D]+"
SYMBOLS = r"[#*$%&|<>]"
MIN_WORDS = 50
MAX_REPEAT_PERCENT = 50

# Rules on lines. Shares are in percent of the line's words, counted by the spaces between them.
MAX_SEPARATORS = 20
MAX_SYMBOL_WORDS = 30
MIN_UNPUNCTUATED_WORDS = 5
MAX_UNPUNCTUATED_WORDS = 60
MAX_BOILERPLATE_WORDS = 20
MAX_LOSS = 50
SEPARATORS = ("|", "»", "«", "›", "‹", "•", "·", "→")
SEPARATOR = "[|»«›‹•·→]+"
SYMBOL_WORD = r"[#*$%&|<>{}\[\]~^=]{2,}"
PUNCTUATION = "[.!?…。！？:;,]"
SENTENCE_END = r"[.!?…。！？:;][\"'”’»)\]]*[\x20\x09-\x0D]*$"
# Phrases of site text in English, German, French and Spanish.
BOILERPLATE = (
    "javascript",
    "cookie policy",
    "accept cookies",
    "privacy policy",
    "terms of use",
    "terms of service",
    "all rights reserved",
    "lorem ipsum",
    "click here",
    "read more",
    "licensed under",
    "page not found",
    "alle rechte vorbehalten",
    "datenschutzerklärung",
    "nutzungsbedingungen",
    "cookies akzeptieren",
    "hier klicken",
    "seite nicht gefunden",
    "tous droits réservés",
    "politique de confidentialité",
    "mentions légales",
    "accepter les cookies",
    "cliquez ici",
    "lire la suite",
    "todos los derechos reservados",
    "política de privacidad",
    "aviso legal",
    "aceptar cookies",
    "haga clic aquí",
    "página no encontrada",
)


def words_of(text: Column) -> Column:
    """Words between white space; null text has none.

    Texts whose only white space is spaces and line ends are split by plain characters, which is
    several times faster than by a pattern.
    """
    value = F.coalesce(text, F.lit(""))
    plain = F.flatten(F.transform(F.split(value, "\n"), lambda line: F.split(line, " ")))
    return F.array_remove(F.when(value.rlike(r"[\x09\x0B-\x0D]"), F.split(value, WHITE)).otherwise(plain), "")


def _repeated_words(words: str) -> Column:
    """Words that lie in a three-word window found at least twice.

    Windows are packed as (hash prefix, position) in one long, so that a plain sort brings equal ones
    together. Only windows whose prefix occurs twice are compared as text; a prefix cannot tell equal
    windows apart, so the result is exact. Work is n log n in the words of a text.
    """
    position = (1 << 30) - 1  # more words than the longest possible string has
    prefix = (1 << 62) - 1 & ~position
    hashes = f"transform(sequence(0, size({words}) - 3), i -> xxhash64({words}[i], {words}[i + 1], {words}[i + 2]))"
    packed = f"sort_array(transform(h, (x, i) -> (x & {prefix}L) | i))"
    near = f"filter(sequence(0, size(s) - 2), k -> s[k + 1] - s[k] <= {position}L)"
    suspects = f"array_distinct(flatten(transform({near}, k -> array(int(s[k] & {position}L), int(s[k + 1] & {position}L)))))"
    as_text = f"concat_ws(' ', {words}[p], {words}[p + 1], {words}[p + 2])"
    texts = f"array_sort(transform(c, p -> named_struct('w', {as_text}, 'p', p)))"
    repeats = (
        "sort_array(transform(filter(t, (x, k) -> (k > 0 AND t[k - 1].w = x.w)"
        " OR (k + 1 < size(t) AND t[k + 1].w = x.w)), x -> x.p))"
    )
    covered = "aggregate(transform(q, (p, k) -> IF(k = 0, 3, least(3, p - q[k - 1]))), 0L, (a, b) -> a + b)"

    def let(name: str, value: str, body: str) -> str:
        """``body`` with ``name`` bound to ``value``, which is evaluated once."""
        return f"transform(array({value}), {name} -> {body})[0]"

    exact = let("t", texts, let("q", repeats, covered))
    checked = let("s", packed, let("c", suspects, f"IF(size(c) = 0, 0L, {exact})"))
    counted = let("h", hashes, f"IF(size(array_distinct(h)) = size(h), 0L, {checked})")
    return F.expr(f"IF(size({words}) < 4, 0L, {counted})")


def _contains_any(line: Column, parts: tuple[str, ...]) -> Column:
    return reduce(lambda a, b: a | b, [line.contains(p) for p in parts])


def line_passes(line: Column) -> Column:
    """Whether one line is kept: prose, not navigation, symbols or site text. Blank lines stay."""
    count = F.size(F.split(line, " "))
    navigation = _contains_any(line, SEPARATORS) & (
        F.regexp_count(line, F.lit(SEPARATOR)) * 100 > count * MAX_SEPARATORS
    )
    symbols = F.regexp_count(line, F.lit(SYMBOL_WORD)) * 100 > count * MAX_SYMBOL_WORDS
    fragment = (count < MIN_UNPUNCTUATED_WORDS) & ~line.rlike(SENTENCE_END)
    heap = (count >= MAX_UNPUNCTUATED_WORDS) & ~line.rlike(PUNCTUATION)
    boilerplate = (count <= MAX_BOILERPLATE_WORDS) & _contains_any(F.lower(line), BOILERPLATE)
    return ~(navigation | symbols | fragment | heap | boilerplate) | ~line.rlike(r"[^\x20\x09-\x0D]")


def judge(docs: DataFrame, text: str = "text", max_loss: int = MAX_LOSS) -> DataFrame:
    """All columns of ``docs`` and ``n_words``, ``word_chars``, ``n_symbols``, ``n_dup_lines``,
    ``n_repeat_words``, ``base_failed``, ``kept_words``, ``cleaned`` (the text without failed lines;
    null stays null) and ``kept``. Input columns of these names are replaced."""
    made = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept_words")
    made += ("cleaned", "kept")
    names = [c for c in docs.columns if c not in made or c == text]
    words, lines, good, row = (fresh(x, docs.columns) for x in ("q_words", "q_lines", "q_good", "q_row"))
    value = F.coalesce(F.col(text), F.lit(""))
    listed = docs.select(
        *names,
        words_of(F.col(text)).alias(words),
        F.split(value, "\n").alias(lines),
    )
    with_word = F.filter(F.col(lines), lambda x: x.rlike(r"[^\x20\x09-\x0D]"))
    counted = listed.select(
        *names,
        words,
        lines,
        F.filter(F.col(lines), line_passes).alias(good),
        F.size(words).cast("long").alias("n_words"),
        F.char_length(F.array_join(F.col(words), "")).cast("long").alias("word_chars"),
        F.regexp_count(value, F.lit(SYMBOLS)).cast("long").alias("n_symbols"),
        (F.size(with_word) - F.size(F.array_distinct(with_word))).cast("long").alias("n_dup_lines"),
        _repeated_words(words).alias("n_repeat_words"),
        # filters on the verdict would be moved below this projection, and its arrays be made again for
        # every use; a filter that needs a row number has to stay above
        F.monotonically_increasing_id().alias(row),
    ).where(F.col(row) >= 0)
    base_failed = (F.col("n_words") < MIN_WORDS) | (
        F.col("n_repeat_words") * 100 > F.col("n_words") * MAX_REPEAT_PERCENT
    )
    joined = F.array_join(F.col(good), "\n")
    judged = counted.select(
        *names,
        "n_words",
        "word_chars",
        "n_symbols",
        "n_dup_lines",
        "n_repeat_words",
        base_failed.alias("base_failed"),
        F.when(F.size(good) == F.size(lines), F.col("n_words"))
        .otherwise(F.size(words_of(joined)).cast("long"))
        .alias("kept_words"),
        F.when(F.col(text).isNotNull(), joined).alias("cleaned"),
    )
    lost = F.col("n_words") - F.col("kept_words")
    return judged.withColumn("kept", ~F.col("base_failed") & (lost * 100 <= F.col("n_words") * max_loss))


def clean(docs: DataFrame, text: str = "text", max_loss: int = MAX_LOSS) -> DataFrame:
    """The documents that are kept, without their failed lines, with the columns of ``docs``.

    A text that loses no line stays as it is. ``n_chars``, where present, follows a text that changes.
    """
    held = docs.select(F.struct(*docs.columns).alias("doc"), F.col(text).alias("text"))
    judged = judge(held, "text", max_loss).where("kept")
    new = {text: F.col("cleaned")}
    if "n_chars" in docs.columns:
        size = F.char_length("cleaned").cast(docs.schema["n_chars"].dataType)
        new["n_chars"] = F.when(F.col("cleaned") == F.col("text"), F.col("doc.n_chars")).otherwise(size)
    return judged.select(*[new.get(c, F.col("doc")[c]).alias(c) for c in docs.columns])
