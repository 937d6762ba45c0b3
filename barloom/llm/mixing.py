"""Mixing sources to target weights by a temperature.

A source's share of all tokens, raised to an exponent between 0 and 1 and normalised,
is its weight.  The exponent is found by bisection: the largest one whose weights have
at least the target entropy, or the smallest one that repeats no source more often than
the limit.  Weights times a token budget give each source its budget, which is realised
in passes: whole passes over all its documents, then blocks of documents in the order of
a seeded permutation until the budget is spent, and inside the last block documents in
the order of their hash.

The corpus is read for two small tables: tokens by source, and tokens by source and
block.  The choice of a document then depends on its own row and its source's and
block's numbers, so texts are never sorted and a source that holds a third of all rows
is spread over its blocks.  Tokens are words between white space, not ids of a tokenizer.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import free_name, saved

#: Hexadecimal digits that name a block at least; a source of more documents than fill so
#: many blocks of BLOCK_DOCS has more digits.
BLOCK_DIGITS, BLOCK_DOCS = 2, 1 << 20
#: Exponents that one bisection round tries at once, and the rounds: 17 ** -8 is below 2e-10.
GRID, ROUNDS = 17, 8
#: Plan tables of at most so many rows are broadcast; larger ones are shuffled.
BROADCAST_ROWS = 100_000
SEED = 17


def n_tokens(text: Column) -> Column:
    """Tokens are runs of anything but white space; null has none."""
    blank = F.translate(F.coalesce(text, F.lit("")), "\t\n\x0b\x0c\r", "     ")
    return F.size(F.filter(F.split(blank, " "), lambda w: w != "")).cast("long")


def bisect_exponent(totals: DataFrame, *, target_entropy: float | None, max_repeats: float | None, budget: float | None) -> float:
    """The exponent for tokens by source (column tokens, positive).

    target_entropy: share of the largest possible entropy, log of the number of sources.
    max_repeats: no source is used more often than so many times.  Both fall as the
    exponent rises, so the answer is the largest exponent that reaches the entropy, and
    the smallest that keeps the limit; if both are given, the limit has the last word.
    Every round tries GRID exponents in one aggregation over the table of sources.
    """
    first = totals.agg(F.sum("tokens"), F.count("*"), F.min("tokens"), F.max("tokens")).first()
    total, n, least, most = (float(x or 0) for x in first)
    if n < 2 or total == 0:
        return 1.0

    def measured(alphas: list[float]) -> list[tuple[float, float]]:
        p = F.log(F.col("tokens") / total)
        row = totals.agg(*[x for a in alphas for x in (F.sum(F.exp(a * p)), F.sum(F.exp(a * p) * a * p))]).first()
        out = []
        for i, a in enumerate(alphas):
            s, t = row[2 * i], row[2 * i + 1]
            entropy = math.log(s) - t / s
            # used tokens / own tokens is largest for the smallest source
            spent = budget if budget is not None else most / (math.exp(a * math.log(most / total)) / s)
            out.append((entropy, math.exp(a * math.log(least / total)) / s * spent / least))
        return out

    reaches = lambda m: m[0] >= (target_entropy or 0) * math.log(n) - 1e-12
    keeps = lambda m: m[1] <= (max_repeats or math.inf) + 1e-9

    def search(good, low: float) -> tuple[float, float]:
        """The two neighbours between which good changes, from low (changed) to 1."""
        high = 1.0
        for _ in range(ROUNDS):
            alphas = [low + (high - low) * i / (GRID - 1) for i in range(GRID)]
            ok = [good(m) for m in measured(alphas)]
            k = next((i for i, x in enumerate(ok) if x != ok[0]), GRID - 1)
            low, high = alphas[k - 1], alphas[k]
        return low, high

    alpha = 1.0
    if not reaches(measured([1.0])[0]):
        alpha = search(reaches, 0.0)[0]
    if not keeps(measured([alpha])[0]):
        alpha = search(keeps, alpha)[1] if keeps(measured([1.0])[0]) else 1.0
    return alpha


def _digest(doc_id: Column, seed: int) -> Column:
    """A digest of a document's id: its first digits name the block, all of it is the place in the block."""
    return F.md5(F.concat(F.lit(f"{seed}:"), F.coalesce(doc_id.cast("string"), F.lit(""))))


def _block(digest: Column, digits: Column) -> Column:
    return F.substr(digest, F.lit(1), digits)


def _small(rows: DataFrame) -> DataFrame:
    """rows, broadcast only after a count."""
    return F.broadcast(rows) if rows.limit(BROADCAST_ROWS + 1).count() <= BROADCAST_ROWS else rows


def plan(docs: DataFrame, *, target_entropy: float | None = 0.95, max_repeats: float | None = 2.0, budget: int | None = None, seed: int = SEED, block_docs: int = BLOCK_DOCS) -> tuple[DataFrame, DataFrame]:
    """From docs (doc_id, source, tokens): sources with their weights, and blocks with their passes.

    Without a budget it is the smallest one that uses every document at least once.
    """
    totals = saved(docs.groupBy("source").agg(F.sum("tokens").alias("tokens"), F.count("*").alias("documents")).where("tokens > 0"), "sources")
    alpha = bisect_exponent(totals, target_entropy=target_entropy, max_repeats=max_repeats, budget=budget)
    all_, raised, most = totals.agg(F.sum("tokens"), F.sum(F.pow(F.col("tokens").cast("double"), F.lit(alpha))), F.max("tokens")).first()
    if all_ is None:
        all_, raised, most = 0, 1.0, 0
    spent = float(budget) if budget is not None else (most ** (1 - alpha) * raised if most else 0.0)
    weight = F.pow(F.col("tokens").cast("double"), F.lit(alpha)) / F.lit(raised)
    digits = F.greatest(F.lit(BLOCK_DIGITS), F.ceil(F.log(16.0, F.col("documents") / block_docs))).cast("int")
    sources = totals.select("source", "tokens", "documents", digits.alias("digits"), weight.alias("weight"), F.lit(alpha).alias("exponent"), (weight * spent).alias("budget"))
    # Rounding must not cost a source its first or last whole pass.
    passes = F.floor(F.col("budget") / F.col("tokens") + 1e-9)
    sources = saved(sources.withColumn("passes", passes).withColumn("rest", F.greatest(F.lit(0.0), F.col("budget") - passes * F.col("tokens"))), "weights")
    rows = docs.select(F.col("source").alias("s"), _digest(F.col("doc_id"), seed).alias("h"), F.col("tokens").alias("n"))
    of = _small(sources.select("source", "digits", "passes", "rest"))
    rows = rows.join(of, rows["s"].eqNullSafe(of["source"])).withColumn("b", _block(F.col("h"), F.col("digits")))
    blocks = rows.groupBy("source", F.col("b").alias("block"), "passes", "rest").agg(F.sum("n").alias("tokens"))
    order = Window.partitionBy("source").orderBy(F.md5(F.concat(F.lit(f"{seed}:"), F.coalesce("source", F.lit("")), F.lit(":"), F.col("block"))), "block")
    ranked = blocks.withColumn("place", F.row_number().over(order)).withColumn("before", F.sum("tokens").over(order) - F.col("tokens"))
    left = F.col("rest") - F.col("before")
    ranked = saved(ranked.select("source", "block", "place", "passes", "tokens", F.when(left <= 0, 0).when(left >= F.col("tokens"), 1).otherwise(2).alias("extra"), left.alias("left")), "blocks")
    # The block in which a source's budget ends: documents in hash order while the budget lasts.
    last = _small(ranked.where("extra = 2").select(F.col("source").alias("s2"), F.col("block").alias("b2"), "left"))
    inside = rows.select("s", "b", "h", "n").join(last, F.col("s").eqNullSafe(F.col("s2")) & (F.col("b") == F.col("b2")))
    by_hash = inside.groupBy("s", "b", "h", "left").agg(F.sum("n").alias("n"))
    spent_at = F.sum("n").over(Window.partitionBy("s", "b").orderBy("h"))
    cut = by_hash.withColumn("upto", spent_at).where("upto <= left").groupBy("s", "b").agg(F.max("h").alias("cut"))
    final = ranked.join(cut, ranked["source"].eqNullSafe(cut["s"]) & (ranked["block"] == cut["b"]), "left").select("source", "block", "place", "passes", "extra", "cut")
    return sources, saved(final, "plan")


def realise(docs: DataFrame, sources: DataFrame, blocks: DataFrame, *, doc_id: str = "doc_id", source: str = "source", seed: int = SEED) -> DataFrame:
    """docs, each row once for every pass that uses it, with __pass and __place (of its block).

    Documents of a source without tokens are in no budget; they stay once.  Where docs has
    a column __pass or __place, the new one has more underscores behind.
    """
    rows = docs.select(F.struct(*[docs[f"`{c}`"] for c in docs.columns]).alias("doc"), docs[f"`{source}`"].alias("s"), _digest(docs[f"`{doc_id}`"], seed).alias("h"))
    of = _small(sources.select(F.col("source").alias("s1"), "digits"))
    rows = rows.join(of, F.col("s").eqNullSafe(F.col("s1")), "left").select("doc", "s", "h", _block(F.col("h"), F.col("digits")).alias("b"))
    by = _small(blocks.select(F.col("source").alias("s2"), F.col("block").alias("b2"), "place", "passes", "extra", "cut"))
    joined = rows.join(by, F.col("s").eqNullSafe(F.col("s2")) & (F.col("b") == F.col("b2")), "left")
    copies = F.coalesce(F.col("passes") + F.when(F.col("extra") == 1, 1).when((F.col("extra") == 2) & (F.col("h") <= F.col("cut")), 1).otherwise(0), F.lit(1)).cast("int")
    used = joined.withColumn("copies", copies).where("copies > 0").withColumn("pass", F.explode(F.sequence(F.lit(1), F.col("copies"))))
    return used.select("doc.*", F.col("pass").alias(free_name(docs, "__pass")), F.coalesce("place", F.lit(0)).alias(free_name(docs, "__place")))


def mix(docs: DataFrame, *, doc_id: str = "doc_id", source: str = "source", text: str = "text", target_entropy: float | None = 0.95, max_repeats: float | None = 2.0, budget: int | None = None, seed: int = SEED, block_docs: int = BLOCK_DOCS) -> tuple[DataFrame, DataFrame]:
    """(mixed documents, sources with weights).

    Null sources are one source.  Null and empty texts have no tokens and follow their
    block.  Repeated rows share a hash and go together.  An empty table stays empty.
    Columns of docs may have any names.
    """
    slim = saved(docs.select(docs[f"`{doc_id}`"].alias("doc_id"), docs[f"`{source}`"].alias("source"), n_tokens(docs[f"`{text}`"]).alias("tokens")), "token-counts")
    sources, blocks = plan(slim, target_entropy=target_entropy, max_repeats=max_repeats, budget=budget, seed=seed, block_docs=block_docs)
    return realise(docs, sources, blocks, doc_id=doc_id, source=source, seed=seed), sources
