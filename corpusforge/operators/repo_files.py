"""Repository files to documents: the folder walk and the concept search."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from ..functions.paths import (
    file_class,
    file_language,
    has_kept_extension,
    in_skipped_folder,
    is_relevant,
)
from ..functions.terms import first_term_position, term_positions
from ..functions.text import let, shorten
from ..rules import DomainRules, Limits
from ..schemas import CODE_BLOCKS, METADATA
from ..sources.jsonl import utc_now
from ..sources.repos import with_content
from ..staging import stage
from .dedup import first_per_key
from .joins import semi_or_anti
from .rows import keep_where

# Where hits per concept are limited, they are first cut down in this many groups, so that a
# concept found in most files does not sort them all in one task.
_HIT_GROUPS = 64

# Up to this many first documents are looked up by a broadcast of their keys; more by a shuffle.
_BROADCAST_KEYS = 50_000


def collected_files(files: DataFrame, rules: DomainRules, limits: Limits = Limits()) -> DataFrame:
    """Files of the walk: folder and suffix filter, decoding, size, relevance.

    The path filters come first and only read ``path``; a text that is cut is cut before relevance.
    """
    path = F.col("path")
    wanted = with_content(files.where(~in_skipped_folder(path, rules) & has_kept_extension(path, rules)))
    others = [name for name in wanted.columns if name != "content"]
    whole = F.struct(F.col("content").alias("whole"))
    sized = keep_where(
        wanted, others, whole, lambda item: (item["whole"] != "") & (F.length(item["whole"]) >= limits.min_content)
    )
    cut = F.struct(shorten(F.col("whole"), limits.max_content).alias("content"))
    return keep_where(sized, others, cut, lambda item: is_relevant(path, item["content"], rules))


def walk_documents(
    files: DataFrame, rules: DomainRules, limits: Limits = Limits(), collected_at: str | None = None
) -> DataFrame:
    found = collected_files(files, rules, limits)
    return _documents(found, rules, F.col("sha"), F.col("size"), F.lit(None).cast("string"), collected_at)


def _search_scope(rules: DomainRules, repo: str | None, language: str | None) -> Column:
    """Files that the search looks at, told by their paths."""
    scope = F.lit(True)
    if repo:
        scope = F.col("repo") == repo
    elif rules.search_owner:
        scope = F.col("repo").startswith(f"{rules.search_owner}/")
    return scope & (file_language(F.col("path")) == language) if language else scope


def _searched_terms(rules: DomainRules, limits: Limits) -> tuple[str, ...]:
    return rules.vocabulary[: limits.searched_concepts]


def search_hits(
    files: DataFrame,
    rules: DomainRules,
    limits: Limits = Limits(),
    repo: str | None = None,
    language: str | None = None,
) -> DataFrame:
    """``(html_url, doc_id, search_term, copies)``: each URL under the first concept that hit it.

    A file's terms are found in one pass over its text, and only keys are shuffled.  With
    ``hits_per_concept`` every concept keeps its first hits by document id.
    """
    terms = _searched_terms(rules, limits)
    doc_id = F.concat_ws("/", F.col("repo"), F.col("path")).alias("doc_id")
    searched = with_content(files.where(_search_scope(rules, repo, language))).withColumn("_lower", F.lower("content"))
    if limits.hits_per_concept is None:
        position = first_term_position(F.col("_lower"), terms)
        hits = searched.select("html_url", doc_id, position.alias("term_position")).where("term_position is not null")
    else:
        hits = searched.select("html_url", doc_id, F.explode(term_positions(F.col("_lower"), terms)).alias("term_position"))
        hits = hits.withColumn("group", F.pmod(F.xxhash64("doc_id", "html_url"), F.lit(_HIT_GROUPS)))
        for key in (["term_position", "group"], ["term_position"]):
            window = Window.partitionBy(*key).orderBy("doc_id", "html_url")
            hits = hits.withColumn("place", F.row_number().over(window))
            hits = hits.where(F.col("place") <= limits.hits_per_concept)
    first = F.min(F.struct("term_position", "doc_id")).alias("first")
    counted = hits.groupBy("html_url").agg(first, F.count(F.lit(1)).alias("copies"))
    return counted.select("html_url", "first.doc_id", _term_at(terms, F.col("first.term_position")).alias("search_term"), "copies")


def _term_at(terms: tuple[str, ...], position: Column) -> Column:
    return F.get(F.lit(list(terms)), position) if terms else F.lit(None).cast("string")


def _by_url(files: DataFrame) -> tuple[DataFrame, DataFrame | None]:
    """Files whose URL is listed once, and those of URLs listed more often, if there are any.

    This reads the URL column alone.  Only where a URL is listed twice two files can claim it; all other files need
    no shuffle, no second scan and no second decoding.
    """
    repeated = files.groupBy("html_url").count().where("count > 1").select("html_url")
    repeated = stage(repeated, "repeated-urls")
    if repeated.isEmpty():
        return files, None
    return semi_or_anti(files, repeated, "html_url", "left_anti"), semi_or_anti(files, repeated, "html_url", "left_semi")


def _collected(
    files: DataFrame, rules: DomainRules, limits: Limits, collected_at: str | None, walked: Column, searched: Column
) -> DataFrame:
    """Documents of the walk and of the search over files of different URLs: one scan, each body decoded once.

    ``walked`` and ``searched`` tell by path which files are looked at for which.
    """
    path, terms = F.col("path"), _searched_terms(rules, limits)
    walked = walked & ~in_skipped_folder(path, rules) & has_kept_extension(path, rules)
    texts = with_content(files.where(walked | searched)).withColumn("_lower", F.lower("content"))
    texts = texts.withColumn("_hit", first_term_position(F.col("_lower"), terms))
    none = F.lit(None)

    def made(item: Column) -> Column:
        whole = item["content"]
        cut = shorten(whole, limits.max_content)
        fits = (whole != "") & (F.length(whole) >= limits.min_content)
        from_walk = F.struct(
            cut.alias("content"), F.col("sha").alias("_sha"), F.col("size").cast("bigint").alias("_size"), none.cast("string").alias("_term")
        )
        from_search = F.struct(
            whole.alias("content"), none.cast("string").alias("_sha"), none.cast("bigint").alias("_size"), _term_at(terms, item["hit"]).alias("_term")
        )
        return F.array(
            F.when(walked & fits & is_relevant(path, cut, rules), from_walk), F.when(searched & fits & item["hit"].isNotNull(), from_search)
        )

    item = F.struct(F.col("content").alias("content"), F.col("_hit").alias("hit"))
    found = texts.select("repo", "path", "html_url", F.inline(F.array_compact(let(item, made))))
    return _documents(found, rules, F.col("_sha"), F.col("_size"), F.col("_term"), collected_at)


def search_documents(
    files: DataFrame,
    rules: DomainRules,
    limits: Limits = Limits(),
    collected_at: str | None = None,
    repo: str | None = None,
    language: str | None = None,
) -> DataFrame:
    """Documents of the concept search.  A URL is claimed before its content is checked."""
    if limits.hits_per_concept is not None:
        return _claimed(files, rules, limits, collected_at, repo, language)
    single, several = _by_url(files)
    found = _collected(single, rules, limits, collected_at, F.lit(False), _search_scope(rules, repo, language))
    return found if several is None else found.unionByName(_claimed(several, rules, limits, collected_at, repo, language))


def _claimed(
    files: DataFrame, rules: DomainRules, limits: Limits, collected_at: str | None, repo: str | None, language: str | None
) -> DataFrame:
    """Search documents where files compete, for a URL or for a concept's first places; only keys of hits are moved."""
    hits = stage(search_hits(files, rules, limits, repo, language), "search-hits")
    doc_id = F.concat_ws("/", F.col("repo"), F.col("path"))
    matched = semi_or_anti(files.withColumn("doc_id", doc_id), hits, ("html_url", "doc_id"), "inner")
    matched = with_content(matched)
    kept = [name for name in matched.columns if name != "content"]
    found = keep_where(
        matched,
        kept,
        F.struct("content"),
        lambda item: (item["content"] != "") & (F.length(item["content"]) >= limits.min_content),
    )
    # A file that is listed twice counts once: as it stands twice itself, one of its rows has to be chosen.
    once = found.where("copies = 1").drop("copies")
    more = hits.where("copies > 1")
    if not more.isEmpty():
        once = once.unionByName(first_per_key(found.where("copies > 1").drop("copies"), F.col("html_url"), "doc_id"))
    nothing = F.lit(None)
    return _documents(once, rules, nothing.cast("string"), nothing.cast("bigint"), F.col("search_term"), collected_at)


def _documents(
    files: DataFrame, rules: DomainRules, sha: Column, size: Column, search_term: Column, collected_at: str | None
) -> DataFrame:
    repo, path = F.col("repo"), F.col("path")
    return files.select(
        F.concat(F.lit("github:"), repo, F.lit("/"), path).alias("id"),
        F.lit("github").alias("source"),
        F.col("html_url").alias("url"),
        F.concat(F.element_at(F.split(repo, "/"), -1), F.lit("/"), path).alias("title"),
        "content",
        file_class(path, rules.implementation_words).alias("content_type"),
        file_language(path).alias("language"),
        F.struct(
            path.alias("path"),
            repo.alias("repo"),
            sha.alias("sha"),
            size.alias("size"),
            search_term.alias("search_term"),
            F.lit(None).cast(CODE_BLOCKS).alias("code_blocks"),
        )
        .cast(METADATA)
        .alias("metadata"),
        (F.lit(collected_at) if collected_at else utc_now()).alias("collected_at"),
    )


def repo_documents(
    files: DataFrame,
    rules: DomainRules,
    limits: Limits = Limits(),
    collected_at: str | None = None,
    limit: int | None = None,
    repo: str | None = None,
    language: str | None = None,
) -> DataFrame:
    """Walk of the configured repositories and search over all files; optionally the first ``limit`` documents.

    ``repo`` and ``language`` restrict the search.  Walk and search share one scan and one decoding of the files.
    """
    in_walk = F.col("repo").isin(*rules.repositories) if rules.repositories else F.lit(True)

    def collect(single: DataFrame, several: DataFrame | None) -> DataFrame:
        docs = _collected(single, rules, limits, collected_at, in_walk, _search_scope(rules, repo, language))
        if several is None:
            return docs
        walked = walk_documents(several.where(in_walk), rules, limits, collected_at)
        return docs.unionByName(walked).unionByName(_claimed(several, rules, limits, collected_at, repo, language))

    if limits.hits_per_concept is not None:
        docs = walk_documents(files.where(in_walk), rules, limits, collected_at).unionByName(
            _claimed(files, rules, limits, collected_at, repo, language)
        )
        return first_documents(docs, rules, limit)
    parts = _by_url(files)
    docs = collect(*parts)
    if not limit:
        return docs
    first = stage(_first_keys(docs, rules, limit), "first-keys")
    # Only the files of the chosen documents are decoded again.
    urls = first.select(F.col("order.url").alias("html_url")).distinct()
    chosen = [part and part.join(_small(urls, limit), "html_url", "left_semi") for part in parts]
    return _with_keys(collect(*chosen), first, rules, limit)


def first_documents(docs: DataFrame, rules: DomainRules, limit: int | None) -> DataFrame:
    """The first ``limit`` documents in collection order; all of them without a limit.

    The order keys alone are sorted; the documents are then looked up by them.
    """
    return _with_keys(docs, _first_keys(docs, rules, limit), rules, limit) if limit else docs


def _first_keys(docs: DataFrame, rules: DomainRules, limit: int) -> DataFrame:
    """(order, among): order keys of the first documents, and how many of equal ones are among them."""
    from .corpus import document_order

    first = docs.select(document_order(rules).alias("order")).orderBy("order").limit(limit)
    return first.groupBy("order").agg(F.count(F.lit(1)).alias("among"))


def _small(keys: DataFrame, limit: int) -> DataFrame:
    return F.broadcast(keys) if limit <= _BROADCAST_KEYS else keys


def _with_keys(docs: DataFrame, first: DataFrame, rules: DomainRules, limit: int) -> DataFrame:
    from .corpus import document_order

    ordered = docs.withColumn("_order", document_order(rules))
    found = ordered.join(_small(first, limit), ordered["_order"] == first["order"])
    nth = F.row_number().over(Window.partitionBy("order").orderBy(F.lit(1)))
    return found.withColumn("_nth", nth).where(F.col("_nth") <= F.col("among")).select(*docs.columns)
