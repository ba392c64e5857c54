"""Mixing sources to target weights by Sainte-Laguë apportionment, in SQL alone.

1. Sizes are word counts; targets share ``volume`` times all words by weight, capped
   at ``max_passes`` times the source with the excess shared out again.
2. The target volume is cut into blocks of equally many words.  Blocks go to sources
   by highest quotients target / (2 s + 1), then, the same way, from each source to
   its shards, so every shard has an integer quota.
3. A shard lays its documents end to end in a seeded order, as a ring.  Its blocks
   follow one another from a seeded place, so a quota takes whole passes and an arc.

Seats need no list of all blocks.  A source's seats differ from target / divisor by
less than the number of sources, so only quotients that close to the cut are ranked.
Shards hold about ``shard_words`` words, whatever the size of their source: a hot
source is many shards, and no window sees more than one shard's documents.

Defined results: NULL and empty texts have size 0, a source of size 0 has target 0,
NULL is a source of its own, weighed last; equal quotients go to the first source by
code point and the first shard by number; repeated rows are laid one after another;
columns beyond doc_id, text and source are not looked at.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

from matchlake.llm.text import WORD, Scratch, documents


@dataclass(frozen=True)
class Settings:
    """weights: repeated over the sources by code point.  volume: words to take for each word there is.
    max_passes: most copies of a source.  block_words: words of a block.  shard_words: words of a shard.
    seed: another one takes other documents."""

    weights: tuple[int, ...] = (5, 2, 1)
    volume: float = 1.5
    max_passes: int = 2
    block_words: int = 64
    shard_words: int = 200_000
    seed: str = "mix-1"


_SIZES = """
SELECT doc_id, source, CAST(coalesce(regexp_count(text, r'{word}'), 0) AS BIGINT) AS size,
    CAST(conv(substr(md5(concat('{seed}:', coalesce(CAST(doc_id AS STRING), ''))), 1, 8), 16, 10) AS BIGINT) AS place
FROM {{docs}}
"""

#: Seats of parties (grp, party, votes) out of ``seats`` in their group: those below ``sure``
#: are certain, the quotients of the next few are ranked against each other.
_SEATS = """
{name}_near AS (
    SELECT grp, party, votes, seats, CAST(floor(votes * seats / total) AS BIGINT) AS mid,
        CAST(ceil(votes / (2 * total / parties) + 0.5) + 1 AS BIGINT) AS wide
    FROM (SELECT *, sum(votes) OVER (PARTITION BY grp) AS total, count(*) OVER (PARTITION BY grp) AS parties FROM {votes})
    WHERE votes > 0),
{name}_ranked AS (
    SELECT *, row_number() OVER (PARTITION BY grp ORDER BY votes / (2 * s + 1) DESC, party, s) AS place
    FROM (SELECT *, explode(sequence(greatest(0, mid - wide), mid + wide)) AS s FROM {name}_near)),
{name} AS (
    SELECT r.grp, r.party, max(sure) + count_if(place <= seats - certain) AS quota
    FROM (SELECT *, greatest(0, mid - wide) AS sure FROM {name}_ranked) r
    JOIN (SELECT grp, sum(greatest(0, mid - wide)) AS certain FROM {name}_near GROUP BY grp) c ON r.grp = c.grp
    GROUP BY r.grp, r.party)"""

_TARGETS = """
WITH sources AS (
    SELECT *, element_at(array({weights}), CAST((number - 1) % {n_weights} + 1 AS INT)) AS weight
    FROM (SELECT source, sum(size) AS source_size, row_number() OVER (ORDER BY source NULLS LAST) AS number FROM {{sizes}} GROUP BY source)),
levels AS (
    SELECT *, ({volume} * sum(source_size) OVER ()
            - coalesce(sum(cap) OVER (ORDER BY ratio, number ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0.0D))
        / sum(weight) OVER (ORDER BY ratio, number ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS level
    FROM (SELECT *, CAST({passes} * source_size AS DOUBLE) AS cap, {passes} * source_size / CAST(weight AS DOUBLE) AS ratio FROM sources))
SELECT number, source, source_size, coalesce(least(cap, weight * (min(CASE WHEN level <= ratio THEN struct(ratio, number, level) END) OVER ()).level), cap) AS target,
    greatest(1, CAST(ceil(source_size / {shard_words}) AS BIGINT)) AS shards
FROM levels
"""

_SOURCE_SEATS = """
WITH votes AS (
    SELECT 0 AS grp, number AS party, target AS votes, CAST(round(sum(target) OVER () / {block_words}) AS BIGINT) AS seats FROM {{targets}}),
{source_seats}
SELECT party AS number, quota FROM source_seats
"""

_SHARDS = """
SELECT t.number, d.place % t.shards AS shard, sum(d.size) AS ring
FROM {sizes} d JOIN {targets} t ON d.source <=> t.source GROUP BY t.number, d.place % t.shards
"""

_ARCS = """
WITH shard_votes AS (
    SELECT s.number AS grp, s.shard AS party, CAST(s.ring AS DOUBLE) AS votes, q.quota AS seats
    FROM {{shards}} s JOIN {{seats}} q ON s.number = q.number),
{shard_seats}
SELECT t.number, q.party AS shard, r.ring, least(q.quota * {block_words}, {passes} * r.ring) AS words,
    CAST(conv(substr(md5(concat('{seed}:', coalesce(t.source, ''), ':', q.party)), 1, 8), 16, 10) AS BIGINT) % r.ring AS first
FROM shard_seats q JOIN {{shards}} r ON q.grp = r.number AND q.party = r.shard JOIN {{targets}} t ON t.number = q.grp
"""

_TAKEN = """
WITH laid AS (
    SELECT d.doc_id, d.size, t.number, t.source_size, t.target, d.place % t.shards AS shard, coalesce(sum(d.size) OVER (PARTITION BY t.number, d.place % t.shards
        ORDER BY d.place, d.doc_id, d.size ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS origin
    FROM {sizes} d JOIN {targets} t ON d.source <=> t.source)
SELECT doc_id, size, source_size, target, CAST(coalesce(
        words DIV ring * size + greatest(0, least(origin + size, first + words % ring) - greatest(origin, first))
        + greatest(0, least(origin + size, first + words % ring - ring) - origin), 0) AS BIGINT) AS taken
FROM laid LEFT JOIN {arcs} USING (number, shard)
"""


def sized(docs: DataFrame, settings: Settings) -> DataFrame:
    """doc_id, source, size and a seeded place of every row."""
    return docs.sparkSession.sql(_SIZES.format(word=WORD, seed=settings.seed), docs=docs.select("doc_id", "source", "text"))


def mix(docs: DataFrame, settings: Settings = Settings()) -> DataFrame:
    """doc_id, size, source_size, target and taken for every row.

    Words are counted once, into a narrow scratch table.  Targets and quotas, one row per
    source or shard, are written as they are known, so each step is a small plan and
    nothing is planned or computed twice.
    """
    spark, scratch = docs.sparkSession, Scratch(docs.sparkSession, "mixing")
    values = {
        "weights": ", ".join(map(str, settings.weights)),
        "n_weights": len(settings.weights),
        "volume": f"{settings.volume}D",
        "passes": settings.max_passes,
        "block_words": settings.block_words,
        "shard_words": settings.shard_words,
        "seed": settings.seed,
        "source_seats": _SEATS.format(name="source_seats", votes="votes"),
        "shard_seats": _SEATS.format(name="shard_seats", votes="shard_votes"),
    }
    sizes = scratch.write("sizes", sized(docs, settings))
    targets = scratch.write("targets", spark.sql(_TARGETS.format(**values), sizes=sizes))
    seats = scratch.write("seats", spark.sql(_SOURCE_SEATS.format(**values), targets=targets))
    shards = scratch.write("shards", spark.sql(_SHARDS, sizes=sizes, targets=targets))
    arcs = scratch.write("arcs", spark.sql(_ARCS.format(**values), shards=shards, seats=seats, targets=targets))
    return spark.sql(_TAKEN, sizes=sizes, targets=targets, arcs=arcs)


def op5_mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mix(documents(spark, sf_dir))


#: The same mix with every quotient of every block listed.
OP5_SQL = r"""
WITH sizes AS (
    SELECT doc_id, source, coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0)::BIGINT AS size,
        ('0x' || substr(md5('mix-1:' || coalesce(doc_id::VARCHAR, '')), 1, 8))::BIGINT AS place
    FROM documents),
sources AS (
    SELECT *, [5, 2, 1][((number - 1) % 3 + 1)::INT] AS weight
    FROM (SELECT source, sum(size)::BIGINT AS source_size, row_number() OVER (ORDER BY source COLLATE "C" NULLS LAST) AS number FROM sizes GROUP BY source)),
levels AS (
    SELECT *, (1.5::DOUBLE * (sum(source_size) OVER ())::DOUBLE
            - coalesce(sum(cap) OVER (ORDER BY ratio, number ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0::DOUBLE))
        / sum(weight) OVER (ORDER BY ratio, number ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS level
    FROM (SELECT *, (2 * source_size)::DOUBLE AS cap, (2 * source_size)::DOUBLE / weight::DOUBLE AS ratio FROM sources)),
targets AS (
    SELECT number, source, source_size, greatest(1, ceil(source_size / 200000.0)::BIGINT) AS shards,
        coalesce(least(cap, weight * (SELECT level FROM levels WHERE level <= ratio ORDER BY ratio, number LIMIT 1)), cap) AS target
    FROM levels),
source_seats AS (
    SELECT number, count(*) AS seats FROM (
        SELECT number FROM targets, (SELECT round(sum(target) / 64)::BIGINT AS seats FROM targets) n,
            LATERAL (SELECT unnest(generate_series(0, seats)) AS s) q
        WHERE target > 0 QUALIFY row_number() OVER (ORDER BY target / (2 * s + 1) DESC, number, s) <= seats)
    GROUP BY number),
placed AS (
    SELECT d.*, t.number, t.source_size, t.target, d.place % t.shards AS shard
    FROM sizes d JOIN targets t ON d.source IS NOT DISTINCT FROM t.source),
shards AS (SELECT number, shard, sum(size)::BIGINT AS ring FROM placed GROUP BY number, shard),
shard_seats AS (
    SELECT number, shard, count(*) AS quota FROM (
        SELECT number, shard FROM shards JOIN source_seats USING (number),
            LATERAL (SELECT unnest(generate_series(0, seats)) AS s) q
        WHERE ring > 0 QUALIFY row_number() OVER (PARTITION BY number ORDER BY ring::DOUBLE / (2 * s + 1) DESC, shard, s) <= seats)
    GROUP BY number, shard),
arcs AS (
    SELECT number, shard, ring, least(quota * 64, 2 * ring) AS words,
        ('0x' || substr(md5('mix-1:' || coalesce(source, '') || ':' || shard::VARCHAR), 1, 8))::BIGINT % ring AS first
    FROM shard_seats JOIN shards USING (number, shard) JOIN targets USING (number)),
laid AS (
    SELECT *, coalesce(sum(size) OVER (PARTITION BY number, shard ORDER BY place, doc_id, size ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS origin FROM placed)
SELECT doc_id, size, source_size, target, coalesce(
        (words // ring) * size + greatest(0, least(origin + size, first + words % ring) - greatest(origin, first))
        + greatest(0, least(origin + size, first + words % ring - ring) - origin), 0)::BIGINT AS taken
FROM laid LEFT JOIN arcs USING (number, shard)
"""
