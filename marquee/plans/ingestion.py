"""Queries S1-S11, N1-N17 and T1: sources, payloads, pages and the ingest stream."""

import uuid

from pyspark.sql import functions as F

from marquee.functions import parse
from marquee.functions.text import slugify
from marquee.plans import landed
from marquee.plans.derived import AS_OF, MOVIES, movies, numbers, omdb, refresh_state, table, tmdb, with_views
from marquee.plans.landed import DETAILS_CTE, DISCOVER_CTE, RATINGS_SQL, TITLES_CTE
from marquee.plans.registry import query
from marquee.schemas import TABLES
from marquee.session import scratch_path
from marquee.sources import frames, pages, payloads, tables
from marquee.sources.deltas import DeltaTable
from marquee.streaming.ingest import ingest_stream, ingest_stream_ledger

_NOW = "TIMESTAMP '2001-08-02 12:00:00'"


def _database(spark) -> str:
    name = f"marquee_{uuid.uuid4().hex}"
    spark.sql(f"CREATE DATABASE {name} LOCATION '{scratch_path(spark, 'db')}'")
    return name


@query("read_frame", "SELECT * FROM customer")
def read_frame(spark, sf):
    source = table(spark, sf, "customer")
    path = frames.write_frame(source, "customer", scratch_path(spark, "frames"), "csv")
    return frames.read_frame(spark, path, schema=source.schema)


@query("write_frame", "SELECT * FROM orders")
def write_frame(spark, sf):
    path = frames.write_frame(table(spark, sf, "orders"), "orders", scratch_path(spark, "frames"))
    return frames.read_frame(spark, path)


@query("zone_io", "SELECT * FROM part")
def zone_io(spark, sf):
    root = scratch_path(spark, "zones")
    frames.save_to_zone(table(spark, sf, "part"), "part", root, "artifacts")
    return frames.load_from_zone(spark, "part", root, "artifacts")


@query("import_parquet", "SELECT * FROM lineitem")
def import_parquet(spark, sf):
    name = f"{_database(spark)}.lineitem"
    tables.import_parquet(spark, name, f"{sf}/lineitem.parquet", scratch_path(spark, "tables"))
    return spark.table(name)


@query("append_parquet", "SELECT * FROM orders UNION ALL SELECT * FROM orders")
def append_parquet(spark, sf):
    name, root = f"{_database(spark)}.orders", scratch_path(spark, "tables")
    tables.append_parquet(spark, name, f"{sf}/orders.parquet", root)
    tables.append_parquet(spark, name, f"{sf}/orders.parquet", root)
    return spark.table(name)


@query("export_table", "SELECT * FROM supplier")
def export_table(spark, sf):
    name = f"{_database(spark)}.supplier"
    tables.import_parquet(spark, name, f"{sf}/supplier.parquet", scratch_path(spark, "tables"))
    return spark.read.parquet(tables.export_table(spark, name, scratch_path(spark, "export")))


@query("append_new_keys",
       "SELECT o_orderkey, o_orderstatus FROM orders WHERE o_orderdate < TIMESTAMP '1999-01-01' "
       "UNION ALL SELECT o_orderkey, 'new' FROM orders WHERE o_orderdate >= TIMESTAMP '1999-01-01'")
def append_new_keys(spark, sf):
    name, root = f"{_database(spark)}.orders", scratch_path(spark, "tables")
    rows = table(spark, sf, "orders").select("o_orderkey", "o_orderstatus", "o_orderdate")
    known = rows.where("o_orderdate < TIMESTAMP_NTZ '1999-01-01 00:00:00'").drop("o_orderdate")
    tables.append_new_keys(spark, name, known, "o_orderkey", root)
    tables.append_new_keys(
        spark, name, rows.withColumn("o_orderstatus", F.lit("new")).drop("o_orderdate"), "o_orderkey", root)
    return spark.table(name)


_CONTRACT = {"movie_id": "INT", "tmdb_id": "INT"}


@query("create_tables", with_views("SELECT " + ", ".join(
    f"CAST({c} AS INT) AS {c}" if c in _CONTRACT else c for c in MOVIES) + " FROM movies_v"))
def create_tables(spark, sf):
    database, root = _database(spark), scratch_path(spark, "tables")
    contracts = {f"{database}.{n}": s for n, s in TABLES.items()}
    tables.create_tables(spark, root, contracts)
    tables.create_tables(spark, root, contracts)
    kinds = TABLES["movies"]
    rows = movies(spark, sf).select(*[F.col(f.name).cast(f.dataType) for f in kinds])
    rows.write.insertInto(f"{database}.movies")
    return spark.table(f"{database}.movies")


_ORDER_TYPES = {"o_orderkey": "bigint", "o_custkey": "bigint", "o_orderstatus": "string", "o_totalprice": "double",
                "o_orderdate": "timestamp_ntz", "o_orderpriority": "string"}


@query("describe_table", " UNION ALL ".join(
    f"SELECT CAST({i} AS INT) AS position, '{c}' AS column_name, '{t}' AS column_type, count({c}) AS non_null FROM orders"
    for i, (c, t) in enumerate(_ORDER_TYPES.items())))
def describe_table(spark, sf):
    name = f"{_database(spark)}.orders"
    tables.import_parquet(spark, name, f"{sf}/orders.parquet", scratch_path(spark, "tables"))
    described = tables.describe_table(spark, name).select("col_name", "data_type")
    counted = tables.column_info(spark.table(name))
    return counted.join(described, (F.col("column_name") == F.col("col_name")) & (F.col("column_type") == F.col("data_type"))
                        ).drop("col_name", "data_type")


_KEYED = {"movies": ("movies_v", "tmdb_id"), "tmdb_movies": ("tmdb_v", "tmdb_id"), "omdb_movies": ("omdb_v", "imdb_id"),
          "numbers_movies": ("numbers_v", "movie_id"), "movie_refresh_state": ("state_v", "movie_id")}


@query("key_faults", with_views(" UNION ALL ".join(
    f"SELECT '{name}' AS table_name, (SELECT count(*) FROM {view} WHERE {key} IS NULL) AS null_keys, "
    f"(SELECT count(*) FROM (SELECT {key} FROM {view} WHERE {key} IS NOT NULL GROUP BY 1 HAVING count(*) > 1)) AS repeated_keys"
    for name, (view, key) in _KEYED.items())))
def key_faults(spark, sf):
    """Rows that break the declared keys, for every table."""
    stored = {"movies": movies, "tmdb_movies": tmdb, "omdb_movies": omdb, "numbers_movies": numbers, "movie_refresh_state": refresh_state}
    parts = [tables.key_faults(read(spark, sf), name) for name, read in stored.items()]
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out


@query("sql", "SELECT o_orderstatus, count(*) AS n FROM orders WHERE o_totalprice > 1000.5 AND o_orderpriority = '5-LOW' GROUP BY 1")
def sql(spark, sf):
    return tables.run_sql(
        spark, "SELECT o_orderstatus, count(*) AS n FROM {orders} WHERE o_totalprice > ? AND o_orderpriority = ? GROUP BY 1",
        [1000.5, "5-LOW"], orders=table(spark, sf, "orders"))


@query("raw_payload_source", with_views(
    "SELECT id, title, release_date, vote_count, vote_average, popularity, genre_text AS genre_ids, adult, video FROM discover_v",
    **DISCOVER_CTE))
def raw_payload_source(spark, sf):
    rows = payloads.read_payloads(spark, landed.land_discover(spark, sf), "discover")
    return rows.withColumn("genre_ids", F.array_join(F.col("genre_ids").cast("array<string>"), ",")).drop("_corrupt_record")


@query("normalize_discover", with_views(
    "SELECT id AS tmdb_id, title, release_date, vote_count, vote_average, popularity, genre_text AS genre_ids, "
    f"{_NOW} AS last_updated_utc FROM discover_v WHERE title IS NOT NULL", **DISCOVER_CTE))
def normalize_discover(spark, sf):
    rows = payloads.read_payloads(spark, landed.land_discover(spark, sf), "discover")
    return payloads.normalize_discover(payloads.quarantine(rows, "discover")[0], AS_OF)


@query("quarantine", with_views(
    "SELECT count(*) FILTER (id % 41 <> 0 AND status IS NOT NULL) AS valid, "
    "count(*) FILTER (id % 41 = 0 OR status IS NULL) AS rejected, count(*) FILTER (id % 41 = 0) AS unparsed FROM details_v",
    **DETAILS_CTE))
def quarantine(spark, sf):
    rows = payloads.read_payloads(spark, landed.land_details(spark, sf), "details")
    ok = payloads.valid_payload(rows, "details")
    return rows.agg(F.count_if(ok).alias("valid"), F.count_if(~ok).alias("rejected"),
                    F.count("_corrupt_record").alias("unparsed"))


@query("normalize_details", with_views(
    "SELECT id AS tmdb_id, * EXCLUDE (id), " + f"{_NOW} AS last_updated_utc FROM details_v WHERE id % 41 <> 0 AND status IS NOT NULL",
    **DETAILS_CTE))
def normalize_details(spark, sf):
    rows = payloads.read_payloads(spark, landed.land_details(spark, sf), "details")
    return payloads.normalize_details(payloads.quarantine(rows, "details")[0], AS_OF)


# The same rules in DuckDB's dialect.
_SPACE = "' ' || chr(9) || chr(10) || chr(13)"
_WHOLE = "CASE WHEN regexp_full_match(trim({0}, " + _SPACE + "), '[+-]?[0-9]+') THEN TRY_CAST(trim({0}, " + _SPACE + ") AS {1}) END"
_MONEY = _WHOLE.format("replace(replace(CASE WHEN BoxOffice NOT IN ('', 'N/A') THEN BoxOffice END, '$', ''), ',', '')", "BIGINT")
_MINUTES = _WHOLE.format("string_split(trim(Runtime, " + _SPACE + "), ' ')[1]", "INT")
_VOTES = _WHOLE.format("replace(imdbVotes, ',', '')", "INT")
_DIGITS = "CASE WHEN regexp_full_match({0}, '[0-9]+') THEN TRY_CAST({0} AS INT) END"
_RATING = ("CASE WHEN regexp_full_match(imdbRating, '[0-9]*\\.?[0-9]*') AND regexp_matches(imdbRating, '[0-9]') "
           "THEN TRY_CAST(imdbRating AS DOUBLE) END")


def _titles(spark, sf):
    return payloads.read_payloads(spark, landed.land_titles(spark, sf), "title")


def _title_fields(spark, sf, **columns):
    return _titles(spark, sf).select("imdbID", *[c.alias(n) for n, c in columns.items()])


@query("normalize_title", with_views(
    "SELECT imdbID AS imdb_id, Title AS title, " + _DIGITS.format("Year") + " AS year, Genre AS genre, CAST(NULL AS VARCHAR) AS director, "
    f"CAST(NULL AS VARCHAR) AS writer, CAST(NULL AS VARCHAR) AS actors, {_RATING} AS imdb_rating, {_VOTES} AS imdb_votes, "
    + _DIGITS.format("Metascore") + f" AS metascore, {_MONEY} AS box_office, Released AS released, {_MINUTES} AS runtime, "
    "CAST(NULL AS VARCHAR) AS language, CAST(NULL AS VARCHAR) AS country, Rated AS rated, Awards AS awards, "
    + ", ".join(f"{e} AS {n}" for n, e in RATINGS_SQL.items()) + f", {_NOW} AS last_updated_utc FROM titles_v WHERE Response <> 'False'",
    **TITLES_CTE))
def normalize_title(spark, sf):
    return payloads.normalize_titles(_titles(spark, sf), AS_OF)


@query("na_to_null", with_views(
    "SELECT imdbID, CASE WHEN BoxOffice NOT IN ('', 'N/A') THEN BoxOffice END AS value FROM titles_v", **TITLES_CTE))
def na_to_null(spark, sf):
    return _title_fields(spark, sf, value=parse.na_to_null("BoxOffice"))


@query("parse_money", with_views(f"SELECT imdbID, {_MONEY} AS value FROM titles_v", **TITLES_CTE))
def parse_money(spark, sf):
    return _title_fields(spark, sf, value=parse.parse_money("BoxOffice"))


@query("parse_minutes", with_views(f"SELECT imdbID, {_MINUTES} AS value FROM titles_v", **TITLES_CTE))
def parse_minutes(spark, sf):
    return _title_fields(spark, sf, value=parse.parse_minutes("Runtime"))


@query("parse_year", with_views("SELECT imdbID, " + _DIGITS.format("Year") + " AS value FROM titles_v", **TITLES_CTE))
def parse_year(spark, sf):
    return _title_fields(spark, sf, value=parse.parse_digits("Year"))


@query("parse_rating", with_views(f"SELECT imdbID, {_RATING} AS value FROM titles_v", **TITLES_CTE))
def parse_rating(spark, sf):
    return _title_fields(spark, sf, value=parse.parse_rating("imdbRating"))


@query("parse_votes", with_views(
    f"SELECT imdbID, {_VOTES} AS votes, " + _DIGITS.format("Metascore") + " AS metascore FROM titles_v", **TITLES_CTE))
def parse_votes(spark, sf):
    return _title_fields(spark, sf, votes=parse.parse_votes("imdbVotes"), metascore=parse.parse_digits("Metascore"))


@query("extract_ratings", with_views(
    "SELECT imdbID, " + ", ".join(f"{e} AS {n}" for n, e in RATINGS_SQL.items()) + " FROM titles_v", **TITLES_CTE))
def extract_ratings(spark, sf):
    return _title_fields(spark, sf, rotten_tomatoes_rating=parse.rotten_tomatoes("Ratings"),
                         meta_critic_rating=parse.metacritic("Ratings"))


@query("ingest_stamp", with_views(f"SELECT movie_id, title, {_NOW} AS last_updated_utc FROM movies_v"))
def ingest_stamp(spark, sf):
    return payloads.ingest_stamp(movies(spark, sf).select("movie_id", "title"), AS_OF)


# No SQL: DuckDB strips accents by another rule than Unicode decomposition.
@query("slugify")
def slugs(spark, sf):
    return table(spark, sf, "documents").select("doc_id", slugify("text").alias("slug"))


_SLUG = "regexp_replace(title, '\\s+', '-', 'g')"
_BASE = "'https://www.the-numbers.com/movie/'"


@query("candidate_urls", with_views(
    f"SELECT movie_id, CAST(0 AS INT) AS pos, {_BASE} || {_SLUG} || '-(' || CAST(year(release_date) AS VARCHAR) || ')' AS url "
    "FROM movies_v WHERE release_date IS NOT NULL UNION ALL "
    f"SELECT movie_id, CASE WHEN release_date IS NULL THEN 0 ELSE 1 END, {_BASE} || {_SLUG} || '#tab=summary' FROM movies_v"))
def candidate_urls(spark, sf):
    return pages.candidate_urls(movies(spark, sf).select("movie_id", "title", "release_date")).select("movie_id", "pos", "url")


# Two tables in front of each page; the second holds the marker.
_PAGE = ("<table><tr><td>Other</td><td>1</td></tr></table><table class=\"m\"><tr><th>Head</th></tr>"
         "<tr><td><b>Production Budget</b></td><td> $%s </td></tr><tr><td>one</td></tr>"
         "<tr><td>Opening&nbsp;Weekend</td><td>$1&amp;2</td></tr>"
         "<tr><td>Inner <table><tr><td>Caf&eacute;</td><td>it&#8217;s <i>so</i></td></tr></table></td></tr>"
         "<tr><td>After</td><td>it</td></tr></table>%s")


def _financial_pages(spark, sf):
    html = F.when(F.col("page_id") % 10 == 0, F.col("html")).otherwise(F.format_string(_PAGE, F.col("page_id").cast("string"), "html"))
    return table(spark, sf, "pages").withColumn("html", html)


@query("extract_label_values",
       "SELECT page_id, 'Production Budget' AS label, '$' || CAST(page_id AS VARCHAR) AS value FROM pages WHERE page_id % 10 <> 0 "
       "UNION ALL SELECT page_id, 'Opening' || chr(160) || 'Weekend', '$1&2' FROM pages WHERE page_id % 10 <> 0 "
       "UNION ALL SELECT page_id, 'Café', 'it’sso' FROM pages WHERE page_id % 10 <> 0 "
       "UNION ALL SELECT page_id, 'After', 'it' FROM pages WHERE page_id % 10 <> 0")
def extract_label_values(spark, sf):
    return _financial_pages(spark, sf).select("page_id", F.explode(pages.label_values("html")).alias("label", "value"))


@query("first_hit", with_views(
    f"SELECT movie_id, CASE WHEN movie_id % 3 = 0 OR release_date IS NULL THEN {_BASE} || {_SLUG} || '#tab=summary' "
    f"ELSE {_BASE} || {_SLUG} || '-(' || CAST(year(release_date) AS VARCHAR) || ')' END AS url, "
    "'$' || CAST(movie_id AS VARCHAR) AS budget FROM movies_v"))
def first_hit(spark, sf):
    # A page for every candidate; the dated page of every third movie carries no table.
    candidates = pages.candidate_urls(movies(spark, sf).select("movie_id", "title", "release_date"))
    html = F.format_string(_PAGE, F.col("movie_id").cast("string"), F.lit(""))
    dated = F.col("url").endswith(")")
    landed_pages = candidates.select("url", F.when(dated & (F.col("movie_id") % 3 == 0), F.lit("<p>none</p>")).otherwise(html).alias("html"))
    hits = pages.first_hit(candidates, landed_pages)
    return hits.select("movie_id", "url", F.col("data")["Production Budget"].alias("budget"))


@query("discover_filter", with_views(
    "SELECT id, title, release_date, vote_count FROM (SELECT *, row_number() OVER (PARTITION BY year(CAST(release_date AS DATE)) "
    "ORDER BY release_date DESC, id) AS rn FROM discover_v WHERE release_date <> '' AND vote_count >= 200 AND NOT adult AND NOT video "
    "AND release_date BETWEEN '1996-01-01' AND '1998-12-31') WHERE rn <= 60", **DISCOVER_CTE))
def discover_filter(spark, sf):
    rows = payloads.read_payloads(spark, landed.land_discover(spark, sf), "discover")
    kept = payloads.discover_filter(rows.drop("_corrupt_record"), 1996, 1998, max_pages=3)
    return kept.select("id", "title", "release_date", "vote_count")


_FETCHED = "TIMESTAMP '2001-08-01 00:00:00' + (id % 24) * INTERVAL '1' HOUR"


_STREAM_SQL = with_views(
    "SELECT id AS tmdb_id, CASE WHEN id % 3 = 0 THEN title || ' v2' ELSE title END AS title, "
    f"CASE WHEN id % 3 = 0 THEN {_FETCHED} + INTERVAL '12' HOUR ELSE {_FETCHED} END AS fetched_at, genres, revenue "
    "FROM details_v WHERE status IS NOT NULL UNION ALL "
    f"SELECT id + 10000000, title || ' late', {_FETCHED} - INTERVAL '10' DAY, genres, revenue FROM details_v WHERE status IS NOT NULL AND id % 5 = 0",
    **DETAILS_CTE)


def _stream_parts(spark, sf):
    """Landings of the same movies, the second newer for a third of them and older for another third; then new movies
    that are ten days late and lines without a key; then the first landing once more."""
    rows = landed.details_rows(spark, sf)
    at = F.expr("TIMESTAMP_NTZ '2001-08-01 00:00:00' + (id % 24) * INTERVAL '1' HOUR")
    first = rows.withColumn("fetched_at", at)
    later = first.withColumn("title", F.concat("title", F.lit(" v2"))).withColumn(
        "fetched_at", F.when(F.col("id") % 3 == 0, F.expr("fetched_at + INTERVAL '12' HOUR")).otherwise(
            F.expr("fetched_at - INTERVAL '5' HOUR"))).where("id % 3 <> 2")
    late = first.where("id % 5 = 0").withColumns({
        "id": F.col("id") + 10000000, "title": F.concat("title", F.lit(" late")), "fetched_at": F.expr("fetched_at - INTERVAL '10' DAY")})
    keyless = first.where("id % 7 = 0").withColumn("id", F.lit(None).cast("bigint"))
    return rows.columns, [first, later, late.unionByName(keyless), first]


def _land(part, columns, landing):
    part.select(F.to_json(F.struct(*columns, F.date_format("fetched_at", "yyyy-MM-dd'T'HH:mm:ss").alias("fetched_at"))).alias("value")
                ).write.mode("append").text(landing)


def _normalize(batch):
    return payloads.normalize_details(batch, AS_OF, carry=["fetched_at"])


@query("ingest_stream", _STREAM_SQL)
def stream_ingest(spark, sf):
    """The landings as a stream into the bucketed table, one stream run after each."""
    columns, parts = _stream_parts(spark, sf)
    landing = scratch_path(spark, "landing-stream")
    path, checkpoint = scratch_path(spark, "stream-table"), scratch_path(spark, "stream-checkpoint")
    for part in parts:
        _land(part, columns, landing)
        ingest_stream(spark, landing, "details", _normalize, path, ["tmdb_id"], checkpoint).awaitTermination()
    return tables.read_bucketed(spark, path).select("tmdb_id", "title", "fetched_at", "genres", "revenue")


@query("ingest_stream_ledger", _STREAM_SQL)
def stream_ingest_ledger(spark, sf):
    """The same landings into a versioned table whose manifests record each committed batch."""
    columns, parts = _stream_parts(spark, sf)
    landing = scratch_path(spark, "landing-stream")
    path, checkpoint = scratch_path(spark, "stream-table"), scratch_path(spark, "stream-checkpoint")
    for part in parts:
        _land(part, columns, landing)
        ingest_stream_ledger(spark, landing, "details", _normalize, path, ["tmdb_id"], checkpoint).awaitTermination()
    return DeltaTable(spark, path).read().select("tmdb_id", "title", "fetched_at", "genres", "revenue")
