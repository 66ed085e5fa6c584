"""The registered queries of this package and their SQL."""

from __future__ import annotations

import corpus_pipeline
import public_tokenizers

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from broadsheet.llm import (
    ann,
    bpe,
    decontaminate,
    jaccard,
    main_text,
    pii,
    runs,
    spelling,
    substring,
    token_counts,
    topk,
    toxicity,
    warc,
)
from broadsheet.session import prepare, scratch_path

#: Code points of a word that op11 takes, at least.
WORD_LEAST = 7


def _table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return prepare(spark).read.parquet(f"{sf}/{name}.parquet")


def op1_nearest_neighbours(spark, sf):
    vectors = _table(spark, sf, "embeddings").select("vec_id", "embedding")
    return ann.nearest(vectors, vectors.filter(F.col("vec_id") % 20 == 0), 20)


def op2_substring_dedup(spark, sf):
    found = substring.remove_repeats(_table(spark, sf, "documents"))
    return found.select("doc_id", "n_words", "n_removed", F.sha2("kept", 256).alias("kept_sha256"))


def op3_byte_bpe(spark, sf):
    ranks = bpe.read_ranks(public_tokenizers.path("byte_bpe_50k.tiktoken"))
    coded = bpe.encode(_table(spark, sf, "documents"), ranks, public_tokenizers.PATTERN, with_decoded=True)
    return coded.select("doc_id", *bpe.digests())


def op4_html_extraction(spark, sf):
    return main_text.extract_main_text(_table(spark, sf, "pages"))


def op5_pii(spark, sf):
    found = pii.find(_table(spark, sf, "documents").select("doc_id", "text"))
    base = F.filter("pii", lambda s: s["order"] < pii.BASE)
    counts = [
        F.size(F.filter(F.col("pii.kind"), F.lit(kind.name).eqNullSafe)).cast("long").alias(f"n_{kind.name}")
        for kind in pii.KINDS[: pii.BASE]
    ]
    return found.select(
        "doc_id", *counts, F.sha2(pii.as_text(base), 256).alias("base_sha256"), pii.as_text("pii").alias("spans")
    )


def op6_ngram_jaccard_join(spark, sf):
    return jaccard.link_documents(_table(spark, sf, "documents"))


def op7_decontamination(spark, sf):
    return decontaminate.find_contaminated(_table(spark, sf, "documents"), _table(spark, sf, "benchmark"))


def op8_token_counts(spark, sf):
    """Counts before and after every document has had its personal data replaced, from its end to its
    start, and a line put in its middle."""
    found = pii.find(_table(spark, sf, "documents").select("doc_id", "text"))
    spans = F.transform(
        F.reverse("pii"),
        lambda s: F.struct(
            s["start"].alias("start"),
            s["end"].alias("stop"),
            F.concat(F.lit("["), F.upper(s["kind"]), F.lit("]")).alias("replacement"),
        ),
    )
    middle = F.floor(F.char_length("text") / 2).cast("int")
    line = F.struct(middle.alias("start"), middle.alias("stop"), F.lit("\n[edited]\n").alias("replacement"))
    edited = found.withColumn("edits", F.concat(spans, F.array(line)))
    ranks = bpe.read_ranks(public_tokenizers.path("byte_bpe_50k.tiktoken"))
    counted = token_counts.count_edited(edited, ranks, public_tokenizers.PATTERN)
    return counted.select(
        "doc_id", "n_before", "n_tokens", "n_edits", "n_encoded", F.sha2("text", 256).alias("text_sha256")
    )


def op9_toxicity(spark, sf):
    docs = _table(spark, sf, "documents")
    model = toxicity.train(docs, _table(spark, sf, "labels"))
    return toxicity.score(docs, model).select(
        "doc_id",
        toxicity.held_out(F.col("doc_id")).alias("held_out"),
        "score",
        (F.col("score") >= toxicity.THRESHOLD).cast("int").alias("predicted"),
    )


def op10_warc(spark, sf):
    path = scratch_path(spark, "warc")
    warc.write_archives(_table(spark, sf, "pages"), path)
    records = warc.read_archives(spark, path, with_payload=False).filter("problem IS NULL")
    page = lambda c: F.regexp_extract(c, "([0-9-]*)$", 1).try_cast("long")
    return records.select(
        page("record_id").alias("page_id"),
        "payload_bytes",
        "payload_digest",
        "record_type",
        page("refers_to").alias("refers_to"),
    )


def op11_spelling_variants(spark, sf):
    """Variants among the words of all texts, of which one in 31, by document, loses a letter first."""
    found = spelling.letter_runs(_table(spark, sf, "documents"), least=WORD_LEAST)
    found = found.withColumn("h", F.crc32(F.concat(F.col("doc_id").cast("string"), F.lit(":"), F.col("word"))))
    place = F.col("h") % F.char_length("word")
    shorter = spelling.without_letter(F.col("word"), place)
    words = found.select(F.when(F.col("h") % 31 == 0, shorter).otherwise(F.col("word")).alias("word"))
    counted = words.filter(F.char_length("word") >= WORD_LEAST).groupBy("word").agg(F.count(F.lit(1)).alias("n"))
    return spelling.group_variants(counted.filter("n >= 2"))


def op12_periodic_runs(spark, sf):
    """Runs of all texts, of which one in ten, by document, repeats words from some place on first."""
    docs = _table(spark, sf, "documents").select("doc_id", "text")
    h = F.crc32(F.col("doc_id").cast("string").cast("binary"))
    g = F.floor(h / 10)
    words = F.when(h % 10 == 0, F.regexp_extract_all("text", F.lit(r"[^\x20\x09-\x0D]+"), F.lit(0)))
    docs = docs.withColumns({"g": g, "words": words})
    docs = docs.withColumn("from", F.when(F.size("words") > 0, F.col("g") % F.size("words")).cast("int"))
    period = 1 + F.floor((F.size("words") - F.col("from")) / (3 + F.col("g") % 8))
    planted = F.array_join(runs.repeat_tail(F.col("words"), F.col("from"), period.cast("int")), " ")
    docs = docs.select("doc_id", F.when(F.size("words") > 0, planted).otherwise(F.col("text")).alias("text"))
    found = runs.find_runs(docs).withColumn("longest", runs.longest(F.col("runs")))
    line = lambda r: F.concat(F.concat_ws(",", r["start"], r["length"], r["period"]), F.lit("\n"))
    return found.select(
        "doc_id",
        F.size("runs").cast("long").alias("n_runs"),
        "longest.start",
        "longest.length",
        "longest.period",
        F.floor(1000 * F.col("longest.length") / F.col("longest.period")).alias("exponent_milli"),
        F.sha2(F.array_join(F.transform("runs", line), ""), 256).alias("runs_sha256"),
        F.sha2("collapsed", 256).alias("collapsed_sha256"),
    )


def op13_exact_topk(spark, sf):
    vectors = _table(spark, sf, "embeddings").select("vec_id", topk.whole(F.col("embedding"), 256).alias("embedding"))
    return topk.search(vectors, vectors.filter(F.col("vec_id") % 50 == 0), 5)


def queries() -> dict:
    return {
        "op1_nearest_neighbours": op1_nearest_neighbours,
        "op2_substring_dedup": op2_substring_dedup,
        "op3_byte_bpe": op3_byte_bpe,
        "op4_html_extraction": op4_html_extraction,
        "op5_pii": op5_pii,
        "op6_ngram_jaccard_join": op6_ngram_jaccard_join,
        "op7_decontamination": op7_decontamination,
        "op8_token_counts": op8_token_counts,
        "op9_toxicity": op9_toxicity,
        "op10_warc": op10_warc,
        "op11_spelling_variants": op11_spelling_variants,
        "op12_periodic_runs": op12_periodic_runs,
        "op13_exact_topk": op13_exact_topk,
        "pipeline": corpus_pipeline.run,
    }


_WORDS = r"coalesce(regexp_extract_all({0}, '[^\x20\x09-\x0D]+'), [])"
_LOWER = "translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
#: The table of crc32, eight halvings of 0 to 255.
_CRC_STEPS = (
    ", ".join(
        f"""s{i} AS (SELECT list_transform(t{i - 1},
              lambda x: CASE WHEN x & 1 = 1 THEN xor(3988292384, x >> 1) ELSE x >> 1 END) AS t{i} FROM {"bits" if i == 1 else f"s{i - 1}"})"""
        for i in range(1, 9)
    )
    + ", crc AS (SELECT t8 FROM s8)"
)
#: Counts of 64 bits have room for 19 steps of ten times.
_FOLLOWED = "r0 AS (SELECT *, coalesce(form, word) AS root FROM forms), " + ", ".join(
    f"""r{i} AS (SELECT a.word, a.n, a.n_near, a.form, a.form_n, b.root FROM r{i - 1} a JOIN r{i - 1} b ON b.word = a.root)"""
    for i in range(1, 6)
).replace("r5 AS", "r8 AS")


def oracle_sql() -> dict[str, str]:
    """The other queries need merges, fitted weights, parsers or positions of matches, and have tests instead."""
    return {
        "op2_substring_dedup": f"""
          WITH docs AS (SELECT doc_id, {_WORDS.format("text")} AS words FROM documents),
          starts AS (SELECT doc_id, words, unnest(range(1, len(words) - {substring.WINDOW - 2})) AS i FROM docs),
          windows AS (SELECT doc_id, i, list_slice(words, i, i + {substring.WINDOW - 1}) AS w FROM starts),
          repeated AS (SELECT doc_id, i FROM windows
            JOIN (SELECT w, min(doc_id) AS first FROM windows GROUP BY w) USING (w) WHERE first < doc_id),
          gone AS (SELECT DISTINCT doc_id, unnest(range(i, i + {substring.WINDOW})) AS i FROM repeated),
          lists AS (SELECT doc_id, list(i) AS gone FROM gone GROUP BY doc_id),
          places AS (SELECT doc_id, words, coalesce(gone, []) AS gone FROM docs LEFT JOIN lists USING (doc_id))
          SELECT doc_id, len(words) AS n_words, len(gone) AS n_removed,
            sha256(coalesce(array_to_string(list_filter(words, lambda w, i: NOT list_contains(gone, i)), ' '), ''))
              AS kept_sha256 FROM places""",
        "op6_ngram_jaccard_join": f"""
          WITH RECURSIVE docs AS (SELECT doc_id, {_WORDS.format(_LOWER)} AS words FROM documents),
          places AS (SELECT doc_id, words, least(len(words), {jaccard.SHINGLE}) AS k FROM docs WHERE len(words) > 0),
          shingles AS (SELECT DISTINCT doc_id, list_slice(words, i, i + k - 1) AS s
            FROM (SELECT *, unnest(range(1, len(words) - k + 2)) AS i FROM places)),
          sizes AS (SELECT doc_id, count(*) AS n FROM shingles GROUP BY doc_id),
          shared AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS n
            FROM shingles a JOIN shingles b ON a.s = b.s AND a.doc_id <> b.doc_id GROUP BY ALL),
          links AS (SELECT a, b FROM shared JOIN sizes x ON x.doc_id = a JOIN sizes y ON y.doc_id = b
            WHERE 100 * shared.n >= {jaccard.PERCENT} * (x.n + y.n - shared.n)),
          reach AS (SELECT a, b FROM links UNION SELECT reach.a, links.b FROM reach JOIN links ON reach.b = links.a)
          SELECT doc_id, coalesce(n, 0) AS n_shingles, least(doc_id, coalesce(least_reached, doc_id)) AS component_id
          FROM documents LEFT JOIN sizes USING (doc_id)
          LEFT JOIN (SELECT a AS doc_id, min(b) AS least_reached FROM reach GROUP BY a) USING (doc_id)""",
        "op10_warc": """
          WITH digests AS (SELECT page_id, coalesce(html, '') AS payload, sha1(coalesce(html, '')) AS hex FROM pages),
          firsts AS (SELECT hex, min(page_id) AS first FROM digests GROUP BY hex)
          SELECT page_id, CAST(octet_length(encode(payload)) AS BIGINT) AS payload_bytes,
            array_to_string(list_transform(range(0, 32), lambda i: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
              1 + ((CAST('0x' || substr(hex, 1 + 5 * (i // 4), 5) AS BIGINT) >> (15 - 5 * (i % 4))) & 31), 1)), '')
              AS payload_digest,
            CASE WHEN page_id = first THEN 'response' ELSE 'revisit' END AS record_type,
            CASE WHEN page_id <> first THEN first END AS refers_to
          FROM digests JOIN firsts USING (hex)""",
        "op11_spelling_variants": f"""
          WITH bits AS (SELECT [CAST(i AS BIGINT) FOR i IN range(0, 256)] AS t0),
          {_CRC_STEPS},
          texts AS (SELECT doc_id, {_LOWER} AS text FROM documents WHERE text IS NOT NULL),
          found AS (SELECT doc_id, unnest(regexp_extract_all(text, '[a-zÀ-ÿ]{{{WORD_LEAST},}}')) AS run FROM texts),
          counted AS (SELECT doc_id, run, count(*) AS n FROM found GROUP BY ALL),
          coded AS (SELECT run, n, hex(encode(doc_id || ':' || run)) AS code FROM counted),
          hashed AS (SELECT run, n, xor(4294967295, list_reduce(list_prepend(4294967295, list_transform(
              range(0, length(code) // 2), lambda i: CAST('0x' || substr(code, 2 * i + 1, 2) AS BIGINT))),
              lambda a, b: xor(a >> 8, t8[(xor(a, b) & 255) + 1]))) AS h FROM coded, crc),
          cut AS (SELECT n, CASE WHEN h % 31 <> 0 THEN run ELSE substr(run, 1, h % length(run))
              || substr(run, h % length(run) + 2, length(run)) END AS word FROM hashed),
          words AS (SELECT word, CAST(sum(n) AS BIGINT) AS n FROM cut WHERE length(word) >= {WORD_LEAST}
              GROUP BY word HAVING sum(n) >= 2),
          gaps AS (SELECT word, n, i, substr(word, 1, i - 1) || substr(word, i + 1, length(word)) AS rest
              FROM (SELECT word, n, unnest(range(1, length(word) + 1)) AS i FROM words)),
          near AS (SELECT a.word, b.word AS other, b.n FROM gaps a JOIN gaps b USING (i, rest) WHERE a.word <> b.word
              UNION SELECT g.word, w.word, w.n FROM gaps g JOIN words w ON w.word = g.rest
              UNION SELECT w.word, g.word, g.n FROM gaps g JOIN words w ON w.word = g.rest),
          ranked AS (SELECT word, other, n, count(*) OVER (PARTITION BY word) AS n_near,
              row_number() OVER (PARTITION BY word ORDER BY n DESC, encode(other)) AS place FROM near),
          forms AS (SELECT w.word, w.n, coalesce(n_near, 0) AS n_near,
              CASE WHEN r.n >= {spelling.RATIO} * w.n THEN other END AS form,
              CASE WHEN r.n >= {spelling.RATIO} * w.n THEN r.n END AS form_n
              FROM words w LEFT JOIN (SELECT * FROM ranked WHERE place = 1) r USING (word)),
          {_FOLLOWED}
          SELECT word, form, root, n, n_near, form_n FROM r8""",
        "op13_exact_topk": """
          WITH whole AS (SELECT vec_id, list_transform(embedding, lambda x: floor(256 * CAST(x AS DOUBLE))) AS v
            FROM embeddings WHERE embedding IS NOT NULL
              AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
          scored AS (SELECT q.vec_id AS query_id, c.vec_id, CAST(list_dot_product(q.v, c.v) AS BIGINT) AS score
            FROM whole q JOIN whole c ON c.vec_id <> q.vec_id WHERE q.vec_id % 50 = 0),
          ranked AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM scored)
          SELECT query_id, CAST(rank AS INTEGER) AS rank, vec_id, score FROM ranked WHERE rank <= 5""",
    }
