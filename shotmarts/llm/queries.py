"""The registered queries of the text operators, over whole tables, and SQL for those it can express."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shotmarts.llm import (
    clustering,
    exact,
    languages,
    mixing,
    ngram_join,
    packing,
    quality,
    repeated_lines,
    resampling,
    sharding,
    suffixes,
    templates,
    winnowing,
)
from shotmarts.llm.common import read

Query = Callable[[SparkSession, str], DataFrame]


def _tokenizer() -> str:
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


def _sharding(spark: SparkSession, folder: str) -> DataFrame:
    placed = sharding.shard(read(spark, folder, "documents"), 16)
    checksum = F.crc32(F.coalesce("text", F.lit("")).cast("binary"))
    return placed.select(
        "doc_id", F.col("shard_size").alias("size"), checksum.alias("text_crc32"),
        F.lit("bytes").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"),
    )


def _templates(spark: SparkSession, folder: str) -> DataFrame:
    return templates.extract(read(spark, folder, "pages"))


def _lines(spark: SparkSession, folder: str) -> DataFrame:
    return repeated_lines.remove(read(spark, folder, "documents"))


def _winnowing(spark: SparkSession, folder: str) -> DataFrame:
    return winnowing.remove(read(spark, folder, "documents"))


def _join(spark: SparkSession, folder: str) -> DataFrame:
    return ngram_join.similarity_components(read(spark, folder, "documents"))


def _languages(spark: SparkSession, folder: str) -> DataFrame:
    docs = read(spark, folder, "documents")
    model = languages.fit(docs.where(~languages.held_out()))
    found = languages.identify(docs, model)
    return found.select("doc_id", languages.held_out().alias("held_out"), "lang_pred", "score")


def _exact(spark: SparkSession, folder: str) -> DataFrame:
    found = exact.classes(read(spark, folder, "documents"))
    return found.select("doc_id", "keep_id", "group_size", "kept", "text_sha256")


def _mixing(spark: SparkSession, folder: str) -> DataFrame:
    mixed = mixing.mix(read(spark, folder, "documents"))
    first = F.round(F.try_element_at("positions", F.lit(1)), 9).alias("first_position")
    return mixed.select(
        "doc_id", "size", "source_size", "target", "taken", first
    ).orderBy("first_position", "doc_id")


def _packing(spark: SparkSession, folder: str) -> DataFrame:
    packed = packing.pack(read(spark, folder, "documents"), _tokenizer(), 2048)
    return packed.select(
        "doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"
    )


def _quality(spark: SparkSession, folder: str) -> DataFrame:
    return quality.judge(read(spark, folder, "documents")).drop("row_id")


def _resampling(spark: SparkSession, folder: str) -> DataFrame:
    return resampling.resample(read(spark, folder, "documents"), read(spark, folder, "benchmark"))


def _clustering(spark: SparkSession, folder: str) -> DataFrame:
    return clustering.cluster(read(spark, folder, "embeddings"))


def _suffixes(spark: SparkSession, folder: str) -> DataFrame:
    return suffixes.remove(read(spark, folder, "documents"))


def queries() -> dict[str, Query]:
    return {
        "op1_histogram_sort": _sharding,
        "op2_site_templates": _templates,
        "op3_line_hashing": _lines,
        "op4_ngram_filters": _languages,
        "op5_best_fit_packing": _packing,
        "op6_extendible_hash": _exact,
        "op7_winnowed_lines": _winnowing,
        "op8_line_frequency_rules": _quality,
        "op9_curriculum_mix": _mixing,
        "op10_ngram_jaccard": _join,
        "op11_bitsliced_resampling": _resampling,
        "op12_lookup_kmeans": _clustering,
        "op13_suffix_array": _suffixes,
    }


#: White space between words, as both engines' patterns have it.
_WORDS = r"regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')"

_EXACT_SQL = r"""
    with texts as (
        select doc_id, length(coalesce(text, '')) as chars,
            regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', '', 'g') as norm
        from documents)
    select doc_id, first_value(doc_id) over best as keep_id,
        count(*) over (partition by norm) as group_size,
        row_number() over best = 1 as kept, sha256(norm) as text_sha256
    from texts window best as (partition by norm order by chars desc, doc_id)"""

_MIXING_SQL = f"""
    with sized as (
        select doc_id, source, len({_WORDS}) as size, md5(cast(doc_id as varchar)) as draw from documents),
    sources as (
        select source, sum(size)::bigint as source_size,
            (row_number() over (order by source nulls last) - 1) % 3 as kind
        from sized group by source),
    capped as (
        select *, [5, 2, 1][kind + 1] as weight, 3 * source_size as cap from sources),
    levels as (
        select *, ((sum(source_size) over ())::bigint - coalesce(sum(cap) over (
                order by cap / weight, source rows between unbounded preceding and 1 preceding), 0)::bigint)
            / (sum(weight) over (
                order by cap / weight, source rows between current row and unbounded following))::bigint as level
        from capped),
    goals as (
        select source, source_size, kind, least(cap::double,
            (select max(level) from levels where level * weight <= cap) * weight) as target
        from levels),
    drawn as (
        select doc_id, size, source_size, kind, target, floor(target / source_size)::bigint as whole,
            (sum(size) over (partition by d.source order by draw, doc_id))::bigint - size as before
        from sized d join goals g on d.source is not distinct from g.source),
    taken as (
        select *, whole + if(whole < 3 and target > whole * source_size
            and before + size / 2 <= target - whole * source_size, 1, 0) as passes from drawn),
    placed as (
        select *, least(1.0, (before + size / 2) / greatest(target, 1.0)) as share from taken)
    select doc_id, size, source_size, target, passes * size as taken,
        round(case when passes = 0 then null
            when kind = 0 then (1.5 - sqrt(1.5::double * 1.5 - 2 * share)) / 1
            when kind = 1 then share
            else (0.5 - sqrt(0.5::double * 0.5 + 2 * share)) / -1 end, 9) as first_position
    from placed"""

_QUALITY_SQL = rf"""
    with numbered as (
        select row_number() over () as id, doc_id, source, coalesce(text, '') as text, {_WORDS} as words
        from documents),
    grams as (
        select id, pos, count(*) over (partition by id, words[pos], words[pos + 1], words[pos + 2]) as n
        from (select id, words, unnest(range(1, len(words) - 1)) as pos from numbered)),
    repeats as (
        select id, count(distinct pos + k) as n from grams, range(3) t(k) where n > 1 group by id),
    lines as (
        select id, source, text, line, row_number() over (partition by id, line) as place,
            len(regexp_extract_all(line, '[^\x20\x09-\x0D]+')) as words,
            translate(array_to_string(regexp_extract_all(line, '[^\x20\x09-\x0D]+'), ' '),
                'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') as norm
        from (select id, source, text, unnest(string_split(text, chr(10))) as line from numbered)
        where regexp_matches(line, '[^\x20\x09-\x0D]')),
    hosts as (select source, count(distinct text) as n from numbered group by source),
    frequent as (
        select l.source, norm from lines l join hosts h on l.source is not distinct from h.source
        group by l.source, norm, h.n having count(distinct text) > 20 and count(distinct text) > 0.01 * h.n),
    by_text as (
        select id, count(*) filter (place > 1) as dup_lines, count(f.norm) as removed,
            sum(if(f.norm is null, 0, words)) as removed_words
        from lines l left join frequent f on l.norm = f.norm and l.source is not distinct from f.source
        group by id),
    judged as (
        select doc_id, len(words) as n_words, length(array_to_string(words, '')) as word_chars,
            len(regexp_extract_all(text, '[#*$%&|<>]')) as n_symbols,
            coalesce(dup_lines, 0) as n_dup_lines, coalesce(r.n, 0) as n_repeat_words,
            coalesce(removed, 0) as n_removed_lines,
            len(words) - coalesce(removed_words, 0)::bigint as n_left_words
        from numbered left join by_text using (id) left join repeats r using (id))
    select *, n_words < 50 or 100 * n_repeat_words > 50 * n_words as base_failed,
        n_words >= 50 and 100 * n_repeat_words <= 50 * n_words and n_left_words >= 0.2 * n_words as kept
    from judged"""


def _kmeans_sql(k: int = 40, rounds: int = 5, dims: int = 64) -> str:
    """Lloyd's rounds unrolled, one CTE pair per round."""
    dist = f"list_sum(list_transform(range(1, {dims + 1}), lambda i: (v.x[i] - c.x[i]) * (v.x[i] - c.x[i])))"
    parts = [f"""
    vecs as (
        select row_number() over () as rid, vec_id, embedding as e,
            embedding is not null and len(embedding) = {dims}
            and coalesce(list_bool_and(list_transform(embedding, lambda y: y is not null and isfinite(y::double))), false)
            as kept
        from embeddings),
    v as (select rid, vec_id, list_transform(e, lambda y: floor(256 * y::double)::bigint) as x from vecs where kept),
    c0 as (
        select (row_number() over (order by sha256('2:' || vec_id::varchar), array_to_string(x, ',')) - 1)::int as c, x
        from v where vec_id is not null
        qualify row_number() over (order by sha256('2:' || vec_id::varchar), array_to_string(x, ',')) <= {k})"""]
    for r in range(rounds + 1):
        parts.append(f"""
    a{r} as (
        select v.rid, first(c.c order by {dist}, c.c) as c, min({dist}) as d
        from v, c{r} c group by v.rid)""")
        if r == rounds:
            break
        parts.append(f"""
    n{r} as (
        select a.c, i, sum(v.x[i]) as s, count(*) as n
        from a{r} a join v using (rid), range(1, {dims + 1}) t(i) group by a.c, i),
    c{r + 1} as (
        select o.c, coalesce(m.x, o.x) as x from c{r} o left join (
            select c, list(((s - ((s % n) + n) % n) // n)::bigint order by i) as x from n{r} group by c) m
        using (c))""")
    return "with" + ",".join(parts) + f"""
    select vecs.vec_id, a.c as cluster, a.d::bigint as distance,
        (sum(a.d) over (partition by a.c))::bigint as cluster_inertia,
        (sum(a.d) over ())::bigint as inertia,
        sha256(array_to_string(c.x, ',')) as centroid_sha256
    from vecs left join a{rounds} a using (rid) left join c{rounds} c on a.c = c.c"""


def _crc32_sql(word: str) -> str:
    """Unsigned crc32 of a word's UTF-8 bytes, needing the table ``tbl`` of a row in scope. The
    bytes come from code points by UTF-8's rule."""
    cp = "unicode(ch)"
    utf8 = (
        f"flatten(list_transform(string_split({word}, ''), lambda ch: case"
        f" when {cp} < 128 then [{cp}::bigint]"
        f" when {cp} < 2048 then [192 | ({cp} >> 6), 128 | ({cp} & 63)]::bigint[]"
        f" when {cp} < 65536 then [224 | ({cp} >> 12), 128 | (({cp} >> 6) & 63), 128 | ({cp} & 63)]::bigint[]"
        f" else [240 | ({cp} >> 18), 128 | (({cp} >> 12) & 63), 128 | (({cp} >> 6) & 63),"
        f" 128 | ({cp} & 63)]::bigint[] end))"
    )
    step = "lambda c, b: xor(tbl[(xor(c, b) & 255) + 1], c >> 8)"
    return f"xor(list_reduce({utf8}, {step}, 4294967295::bigint), 4294967295::bigint)"


#: crc32's table, built by its rule from the reflected polynomial 0xEDB88320.
_CRC_TABLE = (
    "list_transform(range(256), lambda n: list_reduce(range(8),"
    " lambda c, i: if(c & 1 = 1, xor(3988292384::bigint, c >> 1), c >> 1), n::bigint))"
)


def _resampling_sql(percent: int = 10, least_words: int = 20) -> str:
    words = (
        "regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',"
        r" 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"
    )
    return f"""
    with crc as (select {_CRC_TABLE} as tbl),
    docs as (select row_number() over () as rid, doc_id, {words} as w from documents),
    doc_words as (select rid, unnest(w) as word from docs),
    aim_words as (select unnest({words}) as word from benchmark),
    vocabulary as (
        select word, {_crc32_sql("word")} % 10000 as bucket
        from (select word from doc_words union select word from aim_words), crc),
    s as (select bucket, count(*) as s from doc_words join vocabulary using (word) group by bucket),
    t as (select bucket, count(*) as t from aim_words join vocabulary using (word) group by bucket),
    totals as (select (select count(*) from doc_words) as big_s, (select count(*) from aim_words) as big_t),
    gains as (
        select b.bucket, floor(1000 * ln(((coalesce(t, 0) + 1)::double * (big_s + 10000)::double)
            / ((coalesce(s, 0) + 1)::double * (big_t + 10000)::double)))::bigint as gain
        from (select unnest(range(10000)) as bucket) b left join s using (bucket) left join t using (bucket),
            totals),
    weights as (
        select rid, sum(gain)::bigint as weight from doc_words join vocabulary using (word)
            join gains using (bucket) group by rid),
    scored as (
        select doc_id, len(w)::bigint as n_features, coalesce(weight, 0)::bigint as weight,
            (coalesce(weight, 0) + floor(-1000 * ln(-ln((('0x' || substr(sha256('2024:' || doc_id::varchar), 1, 8))::bigint
                + 0.5) / 4294967296))))::bigint as score,
            doc_id is not null and len(w) >= {least_words} as eligible
        from docs left join weights using (rid)),
    ranked as (
        select *, case when eligible then row_number() over (
            order by eligible desc, score desc, doc_id) end as place,
            count(*) filter (eligible) over () as n
        from scored)
    select doc_id, n_features, weight, score,
        case when place <= {percent} * n // 100 then place end::bigint as rank
    from ranked"""


def oracle_sql() -> dict[str, str]:
    """For the others, hash functions, tokenizers, parsing or components of links are beyond SQL;
    tests hold them against brute force."""
    return {
        "op6_extendible_hash": _EXACT_SQL,
        "op8_line_frequency_rules": _QUALITY_SQL,
        "op9_curriculum_mix": _MIXING_SQL,
        "op11_bitsliced_resampling": _resampling_sql(),
        "op12_lookup_kmeans": _kmeans_sql(),
    }
