"""One query per operator, over its whole table, with the parameters for production use."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tonescape.llm import (
    byte_bpe,
    chosen_path,
    licence_scan,
    main_text,
    part_codes,
    pattern_packing,
    qgram_match,
    quality_rules,
    secret_scan,
    shared_ranking,
    suffix_ranks,
    super_kmers,
    toxicity,
)

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def query(fn):
    QUERIES[fn.__name__] = fn
    return fn


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


@query
def op1_super_kmers(spark, sf_dir):
    return super_kmers.remove_repeats(table(spark, sf_dir, "documents"))


ORACLE["op1_super_kmers"] = r"""
    with words as (
      select doc_id, unnest(ws) word, unnest(generate_series(1, len(ws))) pos
      from (select doc_id, regexp_extract_all(text, '[^\x20\x09-\x0D]+') ws from documents)
    ), windows as (
      select doc_id, pos, string_agg(word, ' ') over w key, count(*) over w n from words
      window w as (partition by doc_id order by pos rows between current row and 19 following)
    ), later as (
      select doc_id, pos from windows where n = 20
      qualify row_number() over (partition by key order by doc_id, pos) > 1
    ), covered as (
      select distinct doc_id, pos + o pos from later, range(20) t(o)
    ), marked as (
      select doc_id, word, pos, c.pos is not null gone from words left join covered c using (doc_id, pos)
    ), counted as (
      select doc_id, count(*) n, count(*) filter (where gone) removed,
             string_agg(word, ' ' order by pos) filter (where not gone) kept
      from marked group by doc_id
    )
    select doc_id, cast(coalesce(n, 0) as bigint) n_words, cast(coalesce(removed, 0) as bigint) n_removed,
           sha256(coalesce(kept, '')) kept_sha256
    from documents left join counted using (doc_id)"""


@query
def op2_suffix_ranks(spark, sf_dir):
    return suffix_ranks.remove_repeats(table(spark, sf_dir, "documents"))


@query
def op3_qgram_match(spark, sf_dir):
    docs, benchmark = (table(spark, sf_dir, name) for name in ("documents", "benchmark"))
    return qgram_match.contaminated(docs, benchmark)


@query
def op4_pattern_packing(spark, sf_dir):
    import public_tokenizers

    path = public_tokenizers.path("byte_bpe_50k.json")
    return pattern_packing.pack(table(spark, sf_dir, "documents"), path)


@query
def op5_licence_scan(spark, sf_dir):
    return licence_scan.scan(table(spark, sf_dir, "documents"), licence_scan.train())


@query
def op6_toxicity(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    return toxicity.score(docs, toxicity.train(docs, table(spark, sf_dir, "labels")))


@query
def op7_main_text(spark, sf_dir):
    return main_text.extract(table(spark, sf_dir, "pages"))


@query
def op8_quality_rules(spark, sf_dir):
    judged = quality_rules.judge(table(spark, sf_dir, "documents"))
    base = ["doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]
    return judged.select(*base, "base_failed", "kept", "host", "shrunk_rate", "host_poor")


@query
def op9_secret_scan(spark, sf_dir):
    found = secret_scan.scan(table(spark, sf_dir, "documents"))
    counts = [F.col(f"judged.{name}").alias(name) for name in ("n_repositories", "n_owners")]
    return found.select(
        "doc_id", "n_assign", "n_access", "n_hex", "base_sha256", "spans", *counts, "n_live", "n_example"
    )


@query
def op10_chosen_path(spark, sf_dir):
    return chosen_path.join(table(spark, sf_dir, "documents"))


@query
def op11_part_codes(spark, sf_dir):
    return part_codes.compress(table(spark, sf_dir, "embeddings"))


def _lloyd_sql(parts: int = 16, entries: int = 64, rounds: int = 2) -> str:
    """The contract in SQL: assignment and means as one pair of relations per round."""
    steps = [
        """kept as (
          select row_number() over (order by vec_id) id, vec_id, label,
                 list_transform(embedding, lambda x: cast(floor(256 * cast(x as double)) as bigint)) v
          from embeddings
          where embedding is not null
            and list_bool_and(list_transform(embedding, lambda x: x is not null and isfinite(x)))
        )""",
        f"""parts as (
          select id, vec_id, label, p, v[p * (len(v) // {parts}) + 1 : (p + 1) * (len(v) // {parts})] x
          from kept, range({parts}) t(p)
        )""",
        f"book0 as (select p, id - 1 e, x c from parts where id <= {entries})",
    ]
    for r in range(rounds + 1):
        steps.append(
            f"""near{r} as (
              select id, p, min(d) d, arg_min(e, d * {entries} + e) e from (
                select id, parts.p, e,
                       cast(list_sum(list_transform(list_zip(x, c), lambda z: (z[1] - z[2]) * (z[1] - z[2]))) as bigint) d
                from parts join book{r} b on parts.p = b.p)
              group by id, p
            )"""
        )
        if r < rounds:
            steps.append(
                f"""book{r + 1} as (
                  select p, e, coalesce(list(m order by i), any_value(c)) c
                  from book{r} left join (
                    select p, e, i, cast(floor(sum(x[i]) / count(*)) as bigint) m
                    from near{r} join parts using (id, p), range(1, len(x) + 1) t(i) group by p, e, i
                  ) using (p, e) group by p, e
                )"""
            )
    steps.append(
        f"""books as (
          select sha256(string_agg(array_to_string(c, ','), ',' order by p, e)) codebooks_sha256 from book{rounds}
        ), coded as (
          select id, cast(sum(d) as bigint) error, string_agg(lpad(lower(to_hex(e)), 2, '0'), '' order by p) code
          from near{rounds} group by id
        )"""
    )
    return f"""with {", ".join(steps)}
        select vec_id, code, error, cast(sum(error) over (partition by label) as bigint) label_error, codebooks_sha256
        from kept join coded using (id), books"""


ORACLE["op11_part_codes"] = _lloyd_sql()


@query
def op12_shared_ranking(spark, sf_dir):
    return shared_ranking.search(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


_TERMS = r"""
    unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                              '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) term"""

ORACLE["op12_shared_ranking"] = f"""
    with counts as (
      select doc_id, term, count(*) tf from (select doc_id, {_TERMS} from documents) group by doc_id, term
    ), lengths as (
      select doc_id, cast(sum(tf) as bigint) n from counts group by doc_id
    ), totals as (
      select count(*) docs, cast(sum(n) as bigint) words from lengths
    ), weights as (
      select term, cast(floor(1000 * ln((2 * docs + 2) / (2 * count(*) + 1))) as bigint) w
      from counts, totals group by term, docs
    ), wanted as (
      select distinct item_id, term from (select item_id, {_TERMS} from benchmark)
    ), scored as (
      select item_id, doc_id,
             cast(sum(w * ((1000000000 * tf) // (1000 * tf + 8 * (100 - 90 + (90 * n * docs) // words)))) as bigint) score
      from wanted join counts using (term) join weights using (term) join lengths using (doc_id), totals
      group by item_id, doc_id
    )
    select item_id, cast(row_number() over (partition by item_id order by score desc, doc_id) as integer) "rank",
           doc_id, score
    from scored where score > 0
    qualify row_number() over (partition by item_id order by score desc, doc_id) <= 10"""


@query
def op13_byte_bpe(spark, sf_dir):
    import public_tokenizers

    path = public_tokenizers.path("byte_bpe_50k.tiktoken")
    return byte_bpe.digests(table(spark, sf_dir, "documents"), path, public_tokenizers.PATTERN)
