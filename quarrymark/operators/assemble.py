"""Joins of labels with pages, and chat examples."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from .. import reference_data as R
from ..functions import html as H
from ..functions import urls as U
from ..functions.jsontext import reformatted, types_of
from .sampling import first_per, hash_rank
from .validate import scored

# What stands before a page's markup in a request.
USER_LEAD = "Generate schema.org JSON-LD for this web page.\n\nHTML:\n"


def labelled_pages(labels: DataFrame, pages: DataFrame, *order: str) -> DataFrame:
    """Labels with the first page of their url, or none."""
    return labels.join(first_per(pages, "url", *order), "url", "left")


def adoption(crawled: DataFrame, marked: DataFrame, key: str = "domain") -> DataFrame:
    """key and whether it is in both or only crawled."""
    own = crawled.select(key).distinct()
    both = own.join(marked.select(key).distinct(), key, "left_semi").withColumn("adopted", F.lit(True))
    return both.unionByName(own.join(marked.select(key).distinct(), key, "left_anti").withColumn("adopted", F.lit(False)))


def inference_queue(crawled: DataFrame, done: DataFrame, fetched: DataFrame, marked: DataFrame, screenshots: DataFrame, key: str = "domain", order: tuple[str, ...] = ()) -> DataFrame:
    """Crawled domains that aren't done and are fetched, with their markup and screenshot where there are any.

    Of several rows of a domain the last one by `order` counts (last by all columns where there is none), as in a map that is
    filled in that order.
    """
    own = crawled.join(done.select(key).distinct(), key, "left_anti").join(fetched.select(key).distinct(), key, "left_semi")
    last = lambda rows: first_per(rows, key, *(F.desc(c) for c in (order or [c for c in rows.columns if c != key]) if c in rows.columns))
    return own.join(last(marked), key, "left").join(last(screenshots), key, "left")


def records_with_html(records: DataFrame, fetched: DataFrame, *order: str, key: str = "url", last: bool = False) -> DataFrame:
    """Records whose page was fetched, with it: the first record of each key in the order, or the last."""
    return first_per(records, key, *((F.desc(c) if last else F.col(c)) for c in order)).join(first_per(fetched, key, *[c for c in fetched.columns if c != key]), key)


def rescored_results(results: DataFrame, pages: DataFrame, key: str = "page_id") -> DataFrame:
    """Results with their page, or none: the last page of a key counts."""
    return results.join(first_per(pages, key, *(F.desc(c) for c in pages.columns if c != key)), key, "left")


def usable(records: DataFrame, jsonld: str = "jsonld", least: float = 0.3) -> DataFrame:
    """Records whose markup is there, valid, and scores enough, with its `result`."""
    rows = scored(records.filter(F.coalesce(F.col(jsonld), F.lit("")).isin("", "{}", "[]", "null") == F.lit(False)), jsonld)
    return rows.filter(F.col("result.valid") & (F.col("result.quality_score") >= least))


def assembled(records: DataFrame, screenshots: DataFrame, *order: str, most: int | None = None, least: float = 0.3, shuffle: bool = True, seed: str = "42") -> DataFrame:
    """Chat examples of records (source_url, jsonld, html): those that are usable, the first `most` in the order, shuffled by hash.

    screenshots: domain, path. Example lines in `value`, with domain, screenshot and quality_score beside them; `rank` is the place.
    """
    rows = usable(records, least=least).withColumn("domain", U.domain(F.col("source_url")))
    if most is not None:
        rows = rows.orderBy(*order).limit(most)
    shots = first_per(screenshots, "domain", *(c for c in screenshots.columns if c != "domain")).select("domain", F.col("path").alias("screenshot"))
    rows = rows.join(shots, "domain", "left")
    meta = F.struct(F.lit("wdc").alias("source"), F.col("result.types").alias("schema_types"), "domain", F.col("result.quality_score").alias("quality_score"))
    out = rows.withColumn("value", chat_example(F.coalesce("html", F.lit("")), F.col("jsonld"), F.col("screenshot"), meta))
    return out.withColumn("rank", hash_rank(*(F.col(c).cast("string") for c in order), seed=seed)) if shuffle else out


def with_synthetic(real: DataFrame, synthetic: DataFrame) -> DataFrame:
    """Both, with their source."""
    return real.withColumn("source", F.lit("wdc")).unionByName(synthetic.withColumn("source", F.lit("synthetic")), allowMissingColumns=True)


def page_example(html: Column, jsonld: Column, screenshot: Column, url: Column, result: Column, most: int = 64_000) -> Column:
    """A chat example whose metadata say whether there is a screenshot; no id."""
    meta = F.struct(url.alias("url"), result["types"].alias("schema_types"), result["quality_score"].alias("quality_score"), result["property_count"].alias("property_count"), screenshot.isNotNull().alias("has_screenshot"))
    return chat_example(html, jsonld, screenshot, meta, most=most, lead=USER_LEAD)


def screened_example(html: Column, jsonld: Column, screenshot: Column, url: Column, result: Column, most: int = 12_000) -> Column:
    """A chat example of raw markup and re-indented JSON-LD; null without a screenshot or where it isn't JSON."""
    meta = F.struct(url.alias("url"), result["types"].alias("schema_types"), result["quality_score"].alias("quality_score"), result["property_count"].alias("property_count"))
    neat = reformatted(jsonld)
    return F.when(screenshot.isNotNull() & neat.isNotNull() & html.isNotNull(), chat_example(html, neat, screenshot, meta, most=most, strip=False))


def _rescore_counts() -> list[Column]:
    passed = F.col("rescore_pass")
    return [F.count("*").alias("total"), F.count_if(passed).alias("passed"), F.count_if(~passed).alias("failed"), F.count_if(passed.isNull()).alias("errors")]


def write_rescored(rows: DataFrame, path: str, final: str, mode: str = "overwrite") -> dict[str, int]:
    """Two sinks of one input: all results, and projections of those that passed; and how many there are in all, passed, failed or have an error.

    The input is evaluated once: it is counted while it is written, and the second sink reads what the first has.
    """
    seen = Observation()
    rows.observe(seen, *_rescore_counts()).write.mode(mode).json(path)
    again = rows.sparkSession.read.schema(rows.schema).json(path)
    again.filter("rescore_pass").select("page_id", "url", "jsonld", "rescore").write.mode(mode).json(final)
    return seen.get


def stream_rescored(stream: DataFrame, path: str, final: str, state: str) -> StreamingQuery:
    """The same for results as they come: a folder for each batch in both sinks, and its counts in path/counts. A batch that comes again overwrites its
    own."""

    def save(batch: DataFrame, number: int) -> None:
        counts = write_rescored(batch, f"{path}/rows/batch={number}", f"{final}/batch={number}")
        batch.sparkSession.createDataFrame([tuple(counts[c] for c in ("total", "passed", "failed", "errors"))], "total long, passed long, failed long, errors long").write.mode("overwrite").json(f"{path}/counts/batch={number}")

    return stream.writeStream.foreachBatch(save).option("checkpointLocation", state).trigger(availableNow=True).start()


def chat_export(results: DataFrame, prompt: str = R.SYSTEM_PROMPT, least: float = 0.5) -> DataFrame:
    """Lines (value) of training examples from results (page_id, url, jsonld, judged) that are valid and whose facts the page holds: messages and metadata
    with the types and the factual score."""
    kept = results.filter(F.col("judged.valid") & (F.col("judged.factual_score") >= least))
    said = lambda role, text: F.struct(F.lit(role).alias("role"), text.alias("content"))
    user = F.concat(F.lit("URL: "), F.coalesce("url", F.lit("")), F.lit("\n\n[Screenshot attached]\n\n[HTML source attached]"))
    about = F.struct(F.col("page_id").cast("string").alias("page_id"), F.col("url"), types_of("jsonld").alias("types"), F.col("judged.factual_score").alias("factual_score"))
    return kept.select(F.to_json(F.struct(F.array(said("system", F.lit(prompt)), said("user", user), said("assistant", F.col("jsonld"))).alias("messages"), about.alias("metadata"))).alias("value"))


def manifest_upsert(manifest: DataFrame, new: DataFrame, key: str = "url") -> DataFrame:
    return manifest.unionByName(new.join(manifest.select(key).distinct(), key, "left_anti"), allowMissingColumns=True)


def chat_example(html: Column, jsonld: Column, screenshot: Column, metadata: Column, prompt: str = R.SYSTEM_PROMPT, most: int = 64_000, lead: str = "", strip: bool = True) -> Column:
    """One JSON line: system, user (image part if any, then text) and assistant messages, and metadata."""
    parts = F.array(F.when(screenshot.isNotNull(), F.to_json(F.struct(F.lit("image").alias("type"), screenshot.alias("image")))), F.to_json(F.struct(F.lit("text").alias("type"), F.concat(F.lit(lead), H.truncated(H.strip_noise(html) if strip else html, most)).alias("text"))))
    user = F.concat(F.lit('{"role":"user","content":['), F.array_join(F.array_compact(parts), ","), F.lit("]}"))
    plain = lambda role, text: F.to_json(F.struct(F.lit(role).alias("role"), text.alias("content")))
    return F.concat(F.lit('{"messages":['), F.concat_ws(",", plain("system", F.lit(prompt)), user, plain("assistant", jsonld)), F.lit('],"metadata":'), F.to_json(metadata), F.lit("}"))


def system_prompt(kind: Column, hints: dict[str, str], prompt: str = R.SYSTEM_PROMPT) -> Column:
    """The prompt, with the type's hint below it where there is one."""
    if not hints:
        return F.lit(prompt)
    hint = F.try_element_at(F.create_map(*(F.lit(x) for kv in hints.items() for x in kv)), kind)
    return F.concat(F.lit(prompt), F.coalesce(F.concat(F.lit("\n\n"), hint), F.lit("")))


def batch_requests(pages: DataFrame, model: str, prompt: str = R.SYSTEM_PROMPT, settings: dict[str, float] | None = None) -> DataFrame:
    """custom_id and request lines for a labelling service.

    pages: page_id, url, html, and where there are any, category_hint (put before the text), schema_type (whose hint follows the prompt) and image (bytes)
    with image_name, whose ending tells its type. settings: of the generation, as they stand.
    """
    has = set(pages.columns)
    text = F.concat(F.lit("URL: "), F.coalesce("url", F.lit("")), F.lit("\n\nHTML source:\n"), H.trimmed(F.col("html")))
    if "category_hint" in has:
        text = F.concat(F.when(F.col("category_hint") != "", F.concat(F.lit("Category hint: "), "category_hint", F.lit("\n\n"))).otherwise(""), text)
    system = system_prompt(F.col("schema_type"), R.TYPE_HINTS, prompt) if "schema_type" in has else F.lit(prompt)
    parts = [F.struct(text.alias("text"), F.lit(None).cast("struct<mime_type:string,data:string>").alias("inline_data"))]
    if "image" in has:
        ending = F.lower(F.substring_index("image_name", ".", -1))
        kind = F.when(ending.isin("jpg", "jpeg"), "image/jpeg").when(ending == "webp", "image/webp").otherwise("image/png")
        shown = F.struct(F.lit(None).cast("string").alias("text"), F.struct(kind.alias("mime_type"), F.base64("image").alias("data")).alias("inline_data"))
        parts = [F.when(F.col("image").isNotNull(), shown), *parts]
    content = F.struct(F.lit("user").alias("role"), F.array_compact(F.array(*parts)).alias("parts"))
    body = [F.struct(F.array(F.struct(system.alias("text"))).alias("parts")).alias("system_instruction"), F.array(content).alias("contents")]
    if settings:
        body.append(F.struct(*(F.lit(v).alias(k) for k, v in settings.items())).alias("generationConfig"))
    request = F.struct(F.lit(model).alias("model"), F.struct(*body).alias("body"))
    return pages.select(F.to_json(F.struct(F.col("page_id").cast("string").alias("custom_id"), request.alias("request"))).alias("value"))


def example_id(*keys: Column | str) -> Column:
    return F.substring(F.md5(F.concat_ws("|", *keys)), 1, 8)
