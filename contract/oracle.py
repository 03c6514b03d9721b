"""SQL counterparts of the registered queries, straight over the given tables.

They share no code with the library: each text builds the stand-in catalogue
with plain joins and computes the expected columns from it.
"""

from __future__ import annotations


def _padded(prefix: str, number: str, width: int) -> str:
    text = f"({number})::varchar"
    return f"'{prefix}' || lpad({text}, greatest({width}, length({text}))::int, '0')"


_ORDER = _padded("tt", "o_orderkey", 9)
_LINE = _padded("te", "k", 9) + " || '-' || n"
_PERSON = _padded("nm", "case when l_partkey % 29 = 0 then -1 else l_suppkey end", 7)

# Common table expressions, in order of dependence.
_CTES = {
    "lines": """
        select l_orderkey as k, l_linenumber as n, max(l_quantity) as quantity
        from lineitem join orders on o_orderkey = l_orderkey
        where o_orderstatus = 'O' group by all""",
    "raw_titles": f"""
        select {_ORDER} as "tconst",
               case o_orderstatus when 'F' then 'movie' when 'O' then 'tvSeries'
                    else 'short' end as "titleType",
               'Title ' || (o_orderkey % 97)
                   || case when o_orderkey % 43 = 0 then repeat('x', 600) else '' end
                   as "primaryTitle",
               'orig' as "originalTitle",
               case when o_orderpriority = '5-LOW' then '1' else '0' end as "isAdult",
               case when o_orderkey % 19 = 0 then '19x5' when o_orderkey % 11 <> 0
                    then year(o_orderdate)::varchar end as "startYear",
               null::varchar as "endYear",
               case when o_orderkey % 17 = 0 then 'n/a' when o_orderkey % 7 <> 0
                    then (o_orderkey % 180 + 1)::varchar end as "runtimeMinutes",
               case when o_orderkey % 13 = 0 then null
                    when o_orderkey % 2 = 0 then c_mktsegment
                    else c_mktsegment || ',' || substr(o_orderpriority, 3) end as genres
        from orders join customer on c_custkey = o_custkey
        union all
        select {_LINE}, 'tvEpisode',
               'Episode ' || n, 'orig', '0',
               case when k % 5 <> 0 then (1995 + (k + n) % 9)::varchar end,
               null, (n * 5 + 15)::varchar, null
        from lines""",
    "ratings": f"""
        select {_ORDER} as "tconst",
               case when o_orderkey % 23 <> 0
                    then (o_orderkey * 7 % 37 + 4) / 4.0::double end as "averageRating",
               (o_orderkey * 37 % 50000 + again)::bigint as "numVotes"
        from orders, (select unnest([0, 1]) as again)
        where (again = 0 or o_orderkey % 41 = 0) and o_orderpriority <> '4-NOT SPECIFIED'
        union all
        select {_LINE},
               ((k * 3 + n * 5) % 37 + 4) / 4.0::double, ((k + n) * 13 % 3000)::bigint
        from lines where quantity >= 10""",
    "raw_episodes": f"""
        select {_LINE} as "tconst",
               case when (k + n) % 31 = 0 then 'tt-none'
                    else {_padded("tt", "k", 9)} end as "parentTconst",
               (case when n <> 7 then n % 3 + 1 end)::int as "seasonNumber",
               n::int as "episodeNumber"
        from lines""",
    "principals": f"""
        select case when l_orderkey % 37 = 0 then 'tt-gone'
                    else {_padded("tt", "l_orderkey", 9)} end as "tconst",
               {_PERSON} as "nconst",
               case when l_returnflag <> 'N'
                    then '["P' || l_partkey || '"]' end as "characters",
               case l_returnflag when 'A' then 'actor' when 'R' then 'actress'
                    else 'director' end as "category"
        from lineitem""",
    "people": f"""
        select {_padded("nm", "s_suppkey", 7)} as "nconst",
               'Person ' || (s_suppkey % 60) as "primaryName"
        from supplier""",
    "basics": """
        select "tconst", "primaryTitle", try_cast("isAdult" as int) as "isAdult",
               try_cast("startYear" as int) as "startYear",
               try_cast("endYear" as int) as "endYear",
               try_cast("runtimeMinutes" as int) as "runtimeMinutes", genres,
               coalesce(genres, '') as genres_array,
               string_split(genres, ',')[1] as primary_genre, "titleType",
               coalesce((try_cast("startYear" as int) // 10 * 10)::varchar, 'unknown')
                   as start_decade
        from raw_titles""",
    "titles": """
        select b.*, r."averageRating", r."numVotes",
               r."averageRating" is not null as is_rated
        from basics b left join ratings r on r."tconst" = b."tconst\"""",
    "episodes": """
        select e.*, own."primaryTitle" as "episodeTitle", ser."primaryTitle" as "seriesTitle",
               own."startYear" as "episodeStartYear", ser."startYear" as "seriesStartYear",
               own."runtimeMinutes" as "episodeRuntimeMinutes",
               ser."runtimeMinutes" as "seriesRuntimeMinutes",
               own.genres as "episodeGenres", ser.genres as "seriesGenres",
               own.primary_genre as "episodePrimaryGenre",
               ser.primary_genre as "seriesPrimaryGenre",
               r1."averageRating" as "episodeAverageRating", r1."numVotes" as "episodeNumVotes",
               r2."averageRating" as "seriesAverageRating", r2."numVotes" as "seriesNumVotes",
               own.start_decade as start_decade, ser.start_decade as series_decade
        from raw_episodes e
        join basics own on own."tconst" = e."tconst"
        join basics ser on ser."tconst" = e."parentTconst"
        left join ratings r1 on r1."tconst" = e."tconst"
        left join ratings r2 on r2."tconst" = e."parentTconst\"""",
    "credits": """
        select p.*, n."primaryName", b."titleType", b."primaryTitle", b."startYear",
               b.start_decade, b.primary_genre, r."averageRating", r."numVotes"
        from principals p
        join basics b on b."tconst" = p."tconst"
        join people n on n."nconst" = p."nconst"
        left join ratings r on r."tconst" = p."tconst\"""",
}


def _with(select: str) -> str:
    ctes = ",\n".join(f"{name} as ({text})" for name, text in _CTES.items())
    return f"with {ctes}\n{select}"


_TOP_SERIES = """
    select "parentTconst" from episodes group by 1
    order by max("seriesNumVotes") desc nulls last, 1 limit 10"""

_MARTS = {
    "titles": "titles_enriched", "episodes": "episodes_enriched",
    "credits": "cast_credits",
}
_SILVER = {
    "basics": "title_basics", "ratings": "title_ratings",
    "raw_episodes": "title_episode", "principals": "title_principals",
    "people": "name_basics",
}
_RAW = {
    "raw_titles": "title.basics.tsv", "ratings": "title.ratings.tsv",
    "raw_episodes": "title.episode.tsv", "principals": "title.principals.tsv",
    "people": "name.basics.tsv",
}


def _counts(names: dict[str, str]) -> str:
    return " union all ".join(
        f"select '{label}' as table_name, count(*) as row_count from {cte}"
        for cte, label in names.items())


_NULLS = " union all ".join(
    f"""select '{c}' as column_name, count(*) - count("{c}") as null_count from raw_titles"""
    for c in ("tconst", "titleType", "primaryTitle", "originalTitle", "isAdult",
              "startYear", "endYear", "runtimeMinutes", "genres"))

_EPISODE_MART = 'select * exclude (series_decade) from episodes'

# mart rows with a title longer than 500 bytes, which no published table takes
_LONG = {
    "titles": """(strlen("primaryTitle") > 500)""",
    "episodes": """(strlen("episodeTitle") > 500 or strlen("seriesTitle") > 500)""",
    "credits": """(strlen("primaryTitle") > 500)""",
}

# reasons a title breaks the tighter rules, in the order of the mart's columns
_REASON = """concat_ws('; ',
    case when length("primaryTitle") > 8 then 'primaryTitle: longer than 8' end,
    case when "startYear" is null then 'startYear: null' end,
    case when regexp_matches(genres, '[^,]{10,}')
         then 'genres_array: longer than 9' end)"""

_SELECTS = {
    "scan_delimited": "select * from raw_titles",
    "null_token_counts": _NULLS,
    "scan_typed_ratings": "select * from ratings",
    "layer_roundtrip": "select * from raw_episodes",
    "partitioned_roundtrip": "select * from basics",
    "partition_columns_from_path":
        'select "titleType", start_decade, count(*) as title_count from titles group by all',
    "partition_file_stats":
        'select "category", count(*) as row_count, true as gathered from principals group by all',
    "clean_titles": "select * from basics",
    "clean_ratings": "select * from ratings",
    "clean_episodes": "select * from raw_episodes",
    "clean_credits": "select * from principals",
    "clean_people": "select * from people",
    "decade_bucket": 'select "tconst", start_decade from basics',
    "split_list": """
        select "tconst", coalesce(len(string_split(genres, ',')), 0)::int as genre_count,
               coalesce(replace(genres, ',', '|'), '') as genre_list from raw_titles""",
    "primary_of_list": 'select "tconst", primary_genre from basics',
    "rated_flag":
        'select "titleType", is_rated, count(*) as title_count from titles group by all',
    "enrich_titles": "select * from titles",
    "enrich_episodes": _EPISODE_MART,
    "enrich_credits": "select * from credits",
    "inner_lookup": """
        select "tconst", p."nconst", "category", "primaryName" as person
        from principals p join people n on n."nconst" = p."nconst\"""",
    "orphan_credits": """
        select * from principals p
        where not exists (select 1 from people n where n."nconst" = p."nconst")""",
    "episode_decade": 'select "tconst", start_decade from episodes',
    "decade_with_parent_fallback": """
        select "tconst", "parentTconst",
               case when start_decade = 'unknown' then series_decade else start_decade end
                   as start_decade from episodes""",
    "first_known_year": """
        select "tconst", case when "episodeStartYear" is not null
                              then "episodeStartYear"::varchar
                              when "seriesStartYear" is not null
                              then "seriesStartYear"::varchar
                              else 'unknown' end as known_year from episodes""",
    "filter_partition_eq": """
        select "tconst", "primaryTitle", start_decade from titles
        where "titleType" = 'movie'""",
    "filter_votes_at_least":
        'select "tconst", "numVotes" from titles where "numVotes" >= 10000',
    "filter_in": """
        select "tconst", "nconst", "category" from credits
        where "category" in ('actor', 'actress')""",
    "filter_not_null": """
        select "tconst", primary_genre, "averageRating" from titles
        where primary_genre is not null and "averageRating" is not null""",
    "count_by_key":
        'select "nconst", count(*) as credit_count from credits group by all',
    "count_null_group": """
        select "seriesTitle", "seasonNumber", count(*) as episode_count
        from episodes group by all""",
    "average_by_key": """
        select "titleType", avg("averageRating") as avg_rating,
               avg("runtimeMinutes") as avg_runtime_minutes from titles group by all""",
    "max_by_key":
        'select "parentTconst", max("seriesNumVotes") as max_votes from episodes group by all',
    "aggregate_gap": """
        select "seriesTitle",
               avg("episodeAverageRating") - avg("seriesAverageRating") as rating_gap
        from episodes group by all""",
    "having_min_count": """
        select "nconst", "category", max("numVotes") as max_votes
        from credits group by all having count(*) >= 10""",
    "sort_mixed": """
        select start_decade, "titleType", count(*) as title_count
        from titles group by all order by start_decade, "titleType" desc""",
    "topk_rows": """
        select "tconst", "numVotes" from titles
        order by "numVotes" desc nulls last, "tconst" limit 50""",
    "topk_groups": """
        select "primaryName", count(*) as credit_count from credits group by all
        order by credit_count desc, "primaryName" limit 15""",
    "topk_hidden_key": _TOP_SERIES,
    "topk_semi_join": f"""
        select "tconst", "parentTconst", "seasonNumber", "episodeNumber" from episodes
        where "parentTconst" in ({_TOP_SERIES})""",
    "publish_bucketed": f"select * from credits where not {_LONG['credits']}",
    "publish_audit": " union all ".join(f"""
        select '{label}' as table_name, count(*) as source_rows,
               count(*) filter (not {_LONG[cte]}) as published_rows,
               count(*) filter ({_LONG[cte]}) as rejected_rows, true as balanced
        from {cte}""" for cte, label in _MARTS.items()),
    "publish_rejects": f"""
        select *, 'primaryTitle: longer than 500' as reject_reason
        from credits where {_LONG['credits']}""",
    "corrupt_row_counts": " union all ".join(f"""
        select '{label}' as table_name, count(*) as row_count, {bad} as corrupt_count
        from {cte}""" for cte, label, bad in (
        (cte, label, """count(*) filter ("averageRating" is null)""" if cte == "ratings"
         else "0::bigint") for cte, label in _RAW.items())),
    "conform_schema": f"select * from titles where {_REASON} = ''",
    "conform_rejects": f"""
        select "tconst", "primaryTitle", "startYear", {_REASON} as reject_reason
        from titles where {_REASON} <> ''""",
    "completeness_audit": " union all ".join([
        *(f"select '{label}' as table_name, count(*) as row_count, count(*) > 0 as has_rows "
          f"from {cte}" for cte, label in _RAW.items()),
        "select 'title.akas.tsv', 0, false"]),
    "layer_row_counts": _counts(_RAW),
    "silver_row_counts": _counts(_SILVER),
    "gold_row_counts": _counts(_MARTS),
    "q1_top_movies": """
        select "primaryTitle", "averageRating", "numVotes", "startYear" from titles
        where "titleType" = 'movie' and "numVotes" >= 10000
        order by "averageRating" desc nulls last, "numVotes" desc, "tconst" limit 20""",
    "q2_season_episodes": f"""
        select "seriesTitle", "seasonNumber", count(*) as episode_count from episodes
        where "parentTconst" in ({_TOP_SERIES})
        group by all order by 1 nulls first, 2 nulls first""",
    "q3_genre_decade_rating": """
        select primary_genre, start_decade, avg("averageRating") as avg_rating,
               count(*) as title_count
        from titles where primary_genre is not null and "averageRating" is not null
        group by all order by start_decade, avg_rating desc, primary_genre""",
    "q4_rating_gap": """
        select * exclude (n), avg_episode_rating - avg_series_rating as rating_gap from (
            select "seriesTitle", avg("episodeAverageRating") as avg_episode_rating,
                   avg("seriesAverageRating") as avg_series_rating, count(*) as n
            from episodes
            where "episodeAverageRating" is not null and "seriesAverageRating" is not null
            group by all)
        where n >= 10 order by rating_gap desc, "seriesTitle" limit 20""",
    "q5_top_credited": """
        select "primaryName", count(*) as credit_count from credits
        where "category" in ('actor', 'actress')
        group by all order by 2 desc, 1 limit 25""",
    "q6_runtime_by_type_decade": """
        select "titleType", start_decade, avg("runtimeMinutes") as avg_runtime_minutes,
               count(*) as title_count
        from titles where "runtimeMinutes" is not null
        group by all order by start_decade, "titleType\"""",
}

# over given tables only
_NATIVE = {
    "enrich_documents": """
        select d.doc_id, lang, source, quality, toxic, quality is not null as is_labelled
        from documents d left join labels l on l.doc_id = d.doc_id""",
    "nation_roles": """
        select cn.n_name as customer_nation, sn.n_name as supplier_nation,
               count(*) as line_count
        from lineitem
        join orders on o_orderkey = l_orderkey
        join customer on c_custkey = o_custkey
        join supplier on s_suppkey = l_suppkey
        join nation cn on cn.n_nationkey = c_nationkey
        join nation sn on sn.n_nationkey = s_nationkey
        group by all""",
}

ORACLE: dict[str, str] = {
    **{name: _with(text) for name, text in _SELECTS.items()}, **_NATIVE,
}
