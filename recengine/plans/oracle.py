"""Independent DuckDB SQL for every SQL-expressible query of the catalogue.

The driver registers the parquet tables as views; each statement derives ``ratings`` and
``movies`` from them with the same mapping as :mod:`recengine.sources.fixtures`.
Column names equal the Spark query's names.
"""

from __future__ import annotations

from recengine import schemas as S
from recengine.operators import neighbours as N

ORDER = "timestamp, l_orderkey, l_linenumber, movieId, l_suppkey, l_extendedprice"

BASE = """
ratings as (
  select o_custkey as userId, l_partkey as movieId, ceil(l_quantity / 5) / 2.0::double as rating,
         epoch(o_orderdate)::bigint as timestamp,
         l_orderkey, l_linenumber, l_suppkey, l_extendedprice
  from lineitem join orders on l_orderkey = o_orderkey),
movies as (
  select p_partkey as movieId,
         case when p_partkey % 97 = 0 then p_name
              else concat(p_name, ' (', cast(1949 + p_size as varchar), ')') end as title,
         concat_ws('|', p_type,
                   case when p_partkey % 3 >= 1 then split_part(p_name, ' ', 1) end,
                   case when p_partkey % 3 = 2 then split_part(p_name, ' ', 2) end) as genres
  from part),
labeled as (
  select *, case when rating >= 3.5 then 1 else 0 end as label from ratings)"""


def two_dec(x: str) -> str:
    return f"format('{{:,.2f}}', round(({x})::double, 9))"


YEAR = "coalesce(try_cast(regexp_extract(trim(title), '.(\\d{4}).$', 1) as integer), 1990)"

MOVIE_ATTR = f"""
movie_attr as (
  select movieId, title, genres, {YEAR} as releaseYear,
         string_split(genres, '|')[1] as movieGenre1,
         string_split(genres, '|')[2] as movieGenre2,
         string_split(genres, '|')[3] as movieGenre3
  from movies),
movie_stats as (
  select movieId, count(*) as movieRatingCount,
         {two_dec('avg(rating)')} as movieAvgRating,
         {two_dec('coalesce(stddev_samp(rating), 0)')} as movieRatingStddev
  from labeled group by movieId),
movie_features as (
  select l.*, a.title, a.genres, coalesce(a.releaseYear, 1990) as releaseYear,
         a.movieGenre1, a.movieGenre2, a.movieGenre3,
         coalesce(s.movieRatingCount, 0)::bigint as movieRatingCount, s.movieAvgRating, s.movieRatingStddev
  from labeled l left join movie_attr a on l.movieId = a.movieId
                 left join movie_stats s on l.movieId = s.movieId)"""

TOP_GENRES = ("list_transform(list_sort(list_transform(list_distinct(g), lambda q: "
              "{'n': -len(list_filter(g, lambda y: y = q)), 'v': q})), lambda k: k.v)")

USER_FEATURES = f"""
uw as (
  select *,
    list(movieId) filter (where label = 1) over ww as hist,
    count(*) over ww as userRatingCount,
    avg(releaseYear) over ww as ayear, stddev_samp(releaseYear) over ww as syear,
    avg(rating) over ww as arating, stddev_samp(rating) over ww as srating,
    list(genres) filter (where label = 1 and genres is not null) over ww as gl
  from movie_features
  window ww as (partition by userId order by {ORDER} rows between 100 preceding and 1 preceding)),
ug0 as (
  select *, flatten(list_transform(coalesce(gl, []), lambda z: string_split(z, '|'))) as g from uw),
ug as (
  select *, {TOP_GENRES} as ugen from ug0),
user_features as (
  select movieId, userId, rating, timestamp, label, title, releaseYear,
         movieGenre1, movieGenre2, movieGenre3, movieRatingCount, movieAvgRating, movieRatingStddev,
         hist[-1] as userRatedMovie1, hist[-2] as userRatedMovie2, hist[-3] as userRatedMovie3,
         hist[-4] as userRatedMovie4, hist[-5] as userRatedMovie5,
         userRatingCount,
         coalesce(trunc(ayear)::integer, 0) as userAvgReleaseYear,
         {two_dec('coalesce(syear, 0)')} as userReleaseYearStddev,
         {two_dec('arating')} as userAvgRating,
         {two_dec('coalesce(srating, 0)')} as userRatingStddev,
         ugen[1] as userGenre1, ugen[2] as userGenre2, ugen[3] as userGenre3,
         ugen[4] as userGenre4, ugen[5] as userGenre5,
         l_orderkey, l_linenumber, l_suppkey, l_extendedprice
  from ug where userRatingCount > 1)"""


def with_ctes(*ctes: str) -> str:
    return "with " + ",".join([BASE, *ctes]) + "\n"


SAMPLE_COLS = ", ".join(S.SAMPLE_COLUMNS)

SQL: dict[str, str] = {}

SQL["rating_histogram"] = with_ctes() + """
select rating, count(*) as count, count(*) / sum(count(*)) over () as percentage
from ratings group by rating order by rating"""

SQL["sample_count"] = with_ctes() + "select count(*) as sample_count from labeled"

SQL["sample_label"] = with_ctes() + "select userId, movieId, rating, timestamp, label, l_orderkey, l_linenumber from labeled"

SQL["positive_ratings"] = with_ctes() + """
select userId, movieId, rating, timestamp from ratings where rating >= 3.5"""

SQL["movie_rating_stats"] = with_ctes(MOVIE_ATTR) + "select * from movie_stats"

SQL["movie_features"] = with_ctes(MOVIE_ATTR) + f"""
select movieId, userId, rating, timestamp, label, title, releaseYear, movieGenre1, movieGenre2, movieGenre3,
       movieRatingCount, movieAvgRating, movieRatingStddev, l_orderkey, l_linenumber
from movie_features"""

SQL["user_features"] = with_ctes(MOVIE_ATTR, USER_FEATURES) + f"select {SAMPLE_COLS} from user_features"

_KEYS = "userId, movieId, timestamp, l_orderkey, l_linenumber"
_UF = with_ctes(MOVIE_ATTR, USER_FEATURES)
SQL["user_history"] = _UF + f"select {_KEYS}, userRatedMovie1, userRatedMovie2, userRatedMovie3, userRatedMovie4, userRatedMovie5 from user_features"
SQL["user_rating_count"] = _UF + f"select {_KEYS}, userRatingCount from user_features"
SQL["user_release_year_stats"] = _UF + f"select {_KEYS}, userAvgReleaseYear, userReleaseYearStddev from user_features"
SQL["user_rating_stats"] = _UF + f"select {_KEYS}, userAvgRating, userRatingStddev from user_features"
SQL["user_top_genres"] = _UF + f"select {_KEYS}, userGenre1, userGenre2, userGenre3, userGenre4, userGenre5 from user_features"

SQL["release_year"] = with_ctes(MOVIE_ATTR) + "select movieId, title, releaseYear from movie_attr"
SQL["genre_slots"] = with_ctes(MOVIE_ATTR) + "select movieId, genres, movieGenre1, movieGenre2, movieGenre3 from movie_attr"
SQL["movie_join"] = with_ctes() + """
select r.userId, r.movieId, r.timestamp, r.l_orderkey, r.l_linenumber, m.title, m.genres
from ratings r left join movies m on r.movieId = m.movieId"""
SQL["fill_missing"] = with_ctes() + """
select m.movieId, coalesce(s.c, 0)::bigint as movieRatingCount, round(coalesce(s.a, 0), 9) as movieAvgRating,
       round(coalesce(s.sd, 0), 9) as movieRatingStddev
from movies m left join (select movieId, count(*) as c, avg(rating) as a, stddev_samp(rating) as sd
                         from ratings group by movieId) s on m.movieId = s.movieId"""
SQL["item_id_cast"] = with_ctes() + """
select movieId::varchar as movieIdText, try_cast(movieId::varchar as integer) as movieIdNumber from movies"""

_SEQ = f"""
pos as (select * from ratings where rating >= 3.5 and userId is not null and movieId is not null
                                 and timestamp is not null),
numbered as (select *, row_number() over (partition by userId order by {ORDER}) - 1 as rn from pos),
seqs as (select userId, (rn // 1000)::bigint as seq_part, list(movieId::varchar order by rn) as movieIds
         from numbered group by userId, rn // 1000)"""
SQL["item_sequences"] = with_ctes(_SEQ) + "select userId, seq_part, movieIds from seqs"
SQL["item_sequence_text"] = with_ctes(_SEQ) + "select userId, seq_part, array_to_string(movieIds, ' ') as movieIdStr from seqs"


def md5_bucket_sql(cols: str, n: int, salt: str) -> str:
    parts = ", ".join([f"'{salt}'"] + [f"cast({c.strip()} as varchar)" for c in cols.split(",")])
    return f"(('0x' || substr(md5(concat_ws('_', {parts})), 1, 8))::bigint % {n})"


_SK = "userId, movieId, l_orderkey, l_linenumber"
SQL["sample_fraction"] = with_ctes() + f"""
select {_SK}, timestamp, label from labeled where {md5_bucket_sql(_SK, 2 ** 32, 'sample')} < {round(0.1 * 2 ** 32)}"""
SQL["train_test_split"] = with_ctes() + f"""
select {_SK}, label, case when {md5_bucket_sql(_SK, 2 ** 32, 'split')} < {round(0.8 * 2 ** 32)} then 'train' else 'test' end as split
from labeled"""

SQL["ratings_scan"] = with_ctes() + "select userId, movieId, rating, timestamp from ratings"
_SPOILED = """
spoiled as (
  select concat(userId, ',', movieId, ',', case when l_orderkey % 97 = 0 then 'good' else rating::varchar end, ',',
                case when l_orderkey % 89 = 0 then '1e' else timestamp::varchar end, case when l_orderkey % 83 = 0 then ',7' else '' end) as line,
         case when l_orderkey % 83 = 0 then 'number of cells'
              when l_orderkey % 97 = 0 and l_orderkey % 89 = 0 then 'not a value: rating, timestamp'
              when l_orderkey % 97 = 0 then 'not a value: rating'
              when l_orderkey % 89 = 0 then 'not a value: timestamp' end as reason
  from ratings)"""
SQL["ratings_quarantine"] = with_ctes(_SPOILED) + "select line, reason from spoiled where reason is not null"
SQL["ratings_quarantine_counts"] = with_ctes(_SPOILED) + "select reason, count(*)::bigint as lines from spoiled group by reason"
SQL["movies_scan"] = with_ctes() + "select movieId, title, genres from movies"
SQL["samples_scan"] = _UF + f"select {SAMPLE_COLS} from user_features"
_RK = "userId, movieId, timestamp"
SQL["csv_samples_sink"] = _UF + f"""
select {SAMPLE_COLS},
       case when {md5_bucket_sql(_RK, 2 ** 32, 'split')} < {round(0.8 * 2 ** 32)} then 'train' else 'test' end as split
from user_features where {md5_bucket_sql(_RK, 2 ** 32, 'sample')} < {round(0.1 * 2 ** 32)}"""
SQL["preview"] = with_ctes() + f"""
select userId, movieId, rating, timestamp, label, l_orderkey, l_linenumber from labeled
order by userId, {ORDER} limit 20"""

# --- encoders ----------------------------------------------------------------------------------
_VOCAB = "['" + "', '".join(S.GENRE_VOCAB_TESTDATA) + "']"


def vocab_idx(c: str) -> str:
    return f"(coalesce(list_position({_VOCAB}, {c}), 0) - 1)::integer"


_MOVIES, _USERS = "(select max(movieId) + 1 from ratings)", "(select max(userId) + 1 from ratings)"


def id_bkt(c: str, n: str) -> str:
    return f"case when {c} >= 0 and {c} < {n} then {c} end"


_GENRE_COLS = ["movieGenre1", "movieGenre2", "movieGenre3"] + [f"userGenre{i}" for i in range(1, 6)]
ENCODED = f"""
encoded as (
  select *, {id_bkt('movieId', _MOVIES)} as movieBucket, {id_bkt('userId', _USERS)} as userBucket,
         {id_bkt('userRatedMovie1', _MOVIES)} as ratedMovieBucket,
         {", ".join(f"{vocab_idx(c)} as {c}Index" for c in _GENRE_COLS)}
  from user_features)"""
_ENC = with_ctes(MOVIE_ATTR, USER_FEATURES, ENCODED)

SQL["onehot_item_id"] = with_ctes() + """
select movieId, (select max(movieId) + 1 from movies)::integer as size, movieId::integer as index, 1.0::double as value
from movies"""
SQL["id_bucket"] = _ENC + f"select {_KEYS}, movieBucket, userBucket, ratedMovieBucket from encoded"
SQL["vocab_index"] = _ENC + f"select {_KEYS}, {', '.join(c + 'Index' for c in _GENRE_COLS)} from encoded"


def indicator_sql(c: str, n: int) -> str:
    return f"list_transform(range({n}), lambda j: case when j = {c} then 1.0 else 0.0 end)"


_NV = len(S.GENRE_VOCAB_TESTDATA)
SQL["indicator"] = _ENC + f"""
select {_KEYS}, list_filter(range({2 * _NV}), lambda j: list_concat({indicator_sql('movieGenre1Index', _NV)},
                                                   {indicator_sql('userGenre1Index', _NV)})[j + 1] <> 0)::INTEGER[] as active
from encoded"""
SQL["crossed_bucket"] = _ENC + f"""
select {_KEYS}, case when movieBucket is not null and ratedMovieBucket is not null
                     then (('0x' || substr(md5(concat_ws('_', cast(movieBucket as varchar), cast(ratedMovieBucket as varchar))), 1, 8))::bigint % {S.CROSS_BUCKETS}) end as crossBucket
from encoded"""


def num_sql() -> str:
    parts = []
    for c in ["movieAvgRating", "movieRatingStddev", "movieRatingCount", "userAvgRating", "userRatingStddev",
              "userRatingCount", "releaseYear"]:
        if c.endswith(("Rating", "Stddev")):
            parts.append(f"coalesce(try_cast(replace({c}, ',', '') as double), 0.0)")
        else:
            parts.append(f"coalesce({c}::double, 0.0)")
    return "[" + ", ".join(parts) + "]"


SQL["numeric_features"] = _UF + f"""
select {_KEYS}, {num_sql()} as numeric,
       [{", ".join(f"coalesce(userRatedMovie{i}, 0)::bigint" for i in range(1, 6))}] as history
from user_features"""

_EMB = """
emb as materialized (select vec_id as id, embedding::double[] as vector from embeddings),
cnt as materialized (select count(*) as n from emb),
vecs as materialized (select p.id, vector from (select p_partkey as id, p_partkey % n as k from part, cnt) p join emb on emb.id = p.k),
dim as materialized (select max(len(vector)) as d from emb),
zero as materialized (select list_transform(range(d), lambda x: 0.0::double) as z from dim)"""

VECS = _EMB + """,
withvec as (
  select e.*, coalesce(v1.vector, (select z from zero)) as item_vector,
         coalesce(v2.vector, (select z from zero)) as user_vector,
         coalesce(v3.vector, (select z from zero)) as item_genre_vector,
         coalesce(v4.vector, (select z from zero)) as user_genre_vector
  from encoded e
  left join vecs v1 on v1.id = e.movieId
  left join emb v2 on v2.id = e.userId % (select n from cnt)
  left join emb v3 on v3.id = case when e.movieGenre1Index >= 0 then (select n from cnt) - 10 + e.movieGenre1Index end
  left join emb v4 on v4.id = case when e.userGenre1Index >= 0 then (select n from cnt) - 10 + e.userGenre1Index end)"""
_VEC = with_ctes(MOVIE_ATTR, USER_FEATURES, ENCODED, VECS)


def dense_sql() -> str:
    genres = ", ".join(indicator_sql(f"{c}Index", _NV) for c in _GENRE_COLS)
    return f"flatten([{num_sql()}, item_vector, user_vector, {genres}])"


SQL["dense_features"] = _VEC + f"""
select {_KEYS}, {dense_sql()} as features
from withvec"""


#: The rule's weights repeat after this many units: unit j and unit j + 13 of a layer are equal, so SQL needs one of each.
_PERIOD = 13


def rule_weight(i: int, j: int) -> float:
    return ((31 * i + 17 * j) % 13 - 6) / 600.0


def numbers(values) -> str:
    return "[" + ", ".join(f"{float(v)!r}::double" for v in values) + "]"


def times(units: int, j: int) -> int:
    """How many of a layer's units are equal to unit j, j below the period."""
    return len(range(j, units, _PERIOD))


def next_layer(h: str, units: int, j: int) -> str:
    """Input of unit j behind a layer of ``units`` units, whose different ones are in the list h."""
    return "(" + " + ".join(f"{times(units, r)} * {rule_weight(r, j)!r} * {h}[{r + 1}]" for r in range(min(units, _PERIOD))) + " + 0.01)"


_DIM = 7 + len(_GENRE_COLS) * _NV  # inputs that aren't vectors; the vectors stand between the numbers and the indicators


def first_layer(j: int) -> str:
    """Input of unit j over the dense inputs x, whatever the vectors' length: the weight list is made by the rule."""
    return f"(list_inner_product(x, w[{j + 1}]) + 0.01)"


SQL["dense_forward"] = _VEC + f"""
, dense as materialized (select {_KEYS}, {dense_sql()} as x from withvec),
w as materialized (
  select list(w order by j) as w
  from (select j, list(((31 * i + 17 * j) % 13 - 6) / 600.0::double order by i) as w
        from (select unnest(range({_DIM} + 2 * d)) as i from dim), range({_PERIOD}) u(j) group by j)),
one as (select {_KEYS}, [{", ".join(f"greatest({first_layer(j)}, 0)" for j in range(_PERIOD))}] as h from dense, w),
two as (select {_KEYS}, [{", ".join(f"greatest({next_layer('h', 128, j)}, 0)" for j in range(_PERIOD))}] as h from one)
select {_KEYS}, round(1.0 / (1.0 + exp(-{next_layer('h', 128, 0)})), 6) as score
from two"""


def dot_sql(a: str, b: str) -> str:
    return f"(round(list_sum(list_transform(list_zip({a}, {b}), lambda t: t[1] * t[2])), 6) + 0.0)"


SQL["fm_pair_dots"] = _VEC + f"""
select {_KEYS}, {dot_sql('item_vector', 'user_vector')} as dot_item_user,
       {dot_sql('item_genre_vector', 'user_genre_vector')} as dot_genre_genre,
       {dot_sql('item_genre_vector', 'user_vector')} as dot_itemgenre_user,
       {dot_sql('item_vector', 'user_genre_vector')} as dot_item_usergenre
from withvec"""
SQL["tower_dot_score"] = _VEC + f"""
select {_KEYS}, round(1.0 / (1.0 + exp(-(1.0 * list_sum(list_transform(list_zip(user_vector, item_vector), lambda t: t[1] * t[2])) + 0.0))), 6) as score
from withvec"""

_VECS_ONLY = _EMB
SQL["embedding_lookup"] = with_ctes(_VECS_ONLY) + """
select m.movieId, coalesce(v.vector, (select z from zero)) as vector from movies m left join emb v on v.id = m.movieId"""

# Rows of five slots are joined as narrow (row, slot, id) records; what a slot adds comes from numbers per item.
HIST = """
uf as materialized (select row_number() over () as r, * from user_features),
vec as materialized (select id, vector from vecs),
slot as materialized (
  select r, movieId, unnest([1, 2, 3, 4, 5]) as s,
         unnest([userRatedMovie1, userRatedMovie2, userRatedMovie3, userRatedMovie4, userRatedMovie5]) as id
  from uf)"""
_HIST = with_ctes(MOVIE_ATTR, USER_FEATURES, _VECS_ONLY, HIST)
SQL["history_lookup"] = _HIST + f"""
, found as (select r, s, slot.id is not null as there, coalesce(vector, z) as h from slot left join vec on vec.id = slot.id, zero),
lists as (select r, list(h order by s) as history_vectors, list(there::integer order by s) as history_mask from found group by r)
select {_KEYS}, history_vectors, history_mask from uf join lists using (r)"""
SQL["history_lookup_large"] = SQL["history_lookup"]
SQL["item_vector_sink"] = "select vec_id as id, embedding::double[] as vector from embeddings"


def pooled_sql(weight: str) -> str:
    """Weights of the present slots by an expression over a, b (lists of numbers of the slot's and the row's item), h and c."""
    return f""",
zeros as (select list_transform(range({_PERIOD}), lambda x: 0.0::double) as z from range(1)),
own as materialized (
  select r, s, slot.id is not null as there, coalesce(h.vector, zero.z) as h, coalesce(h.a, zeros.z) as a, coalesce(c.vector, zero.z) as c,
    coalesce(c.b, zeros.z) as b
  from slot left join item h on h.id = slot.id left join item c on c.id = slot.movieId, zero, zeros),
weighed as (select r, s, h, case when there then 1.0 / (1.0 + exp(-({weight}))) else 0.0 end as w from own),
lists as (select r, list(h order by s) as h, list(w order by s) as w from weighed group by r)
select {_KEYS}, list_transform(w, lambda x: round(x, 6) + 0.0) as attention_weights,
       list_transform(list_zip(h[1], h[2], h[3], h[4], h[5]), lambda t: round(
         w[1] * t[1] + w[2] * t[2] + w[3] * t[3] + w[4] * t[4] + w[5] * t[5], 6) + 0.0) as pooled_history
from uf join lists using (r)"""


# The rule unit: <k0, h - c> + <k1, h> + <k2, c> + <k3, h * c> + 0.1, taken apart into a part of h, one of c and the product.
_POOL = [f"list_transform(range(d), lambda j: (({k} * d + j) % 7 - 3) / 50.0::double)" for k in range(4)]
SQL["history_attention_pool"] = _HIST + f"""
, k as (select {", ".join(f"{x} as k{i}" for i, x in enumerate(_POOL))} from dim),
item as materialized (
  select id, vector, [list_inner_product(k0, vector) + list_inner_product(k1, vector)] as a,
    [list_inner_product(k2, vector) - list_inner_product(k0, vector)] as b from vec, k),
k3 as (select k3 as k from k)""" + pooled_sql(
    "a[1] + b[1] + list_inner_product(list_transform(list_zip(h, (select k from k3)), lambda t: t[1] * t[2]), c) + 0.1")


def _unit_weights(block: int, j: int) -> str:
    """Weights of unit j over block 0 (h - c), 1 (h), 2 (c) or 3 (h * c) of its input."""
    return f"list_transform(range(d), lambda i: ((31 * ({block} * d + i) + 17 * {j}) % 13 - 6) / 600.0::double)"


_Z = [f"(a[{j + 1}] + b[{j + 1}] + list_inner_product(hc, (select k from u)[{j + 1}]) + 0.01)" for j in range(_PERIOD)]
_NET = " + ".join(f"{times(32, j)} * {rule_weight(j, 0)!r} * (case when {z} > 0 then {z} else 0.25 * {z} end)" for j, z in enumerate(_Z)) + " + 0.01"
SQL["history_attention_net"] = _HIST + f"""
, u as materialized (select [{", ".join(_unit_weights(3, j) for j in range(_PERIOD))}] as k from dim),
item as materialized (
  select id, vector,
    [{", ".join(f"list_inner_product({_unit_weights(0, j)}, vector) + list_inner_product({_unit_weights(1, j)}, vector)" for j in range(_PERIOD))}] as a,
    [{", ".join(f"list_inner_product({_unit_weights(2, j)}, vector) - list_inner_product({_unit_weights(0, j)}, vector)" for j in range(_PERIOD))}] as b
  from vec, dim)""" + pooled_sql(_NET).replace(
    "weighed as (select r, s, h,", "products as (select *, list_transform(list_zip(h, c), lambda t: t[1] * t[2]) as hc from own),\nweighed as (select r, s, h,"
).replace("from own),\nlists", "from products),\nlists")

SQL["similar_items"] = with_ctes(_VECS_ONLY) + """
select id, round(s, 6) + 0.0 as similarity
from (select id, list_cosine_similarity(vector, (select vector from emb where id = 158)) as s from emb where id <> 158)
order by s desc, id limit 20"""
SQL["nearest_items_exact"] = with_ctes(_VECS_ONLY) + """
select id, round(d, 6) as distance
from (select id, list_distance(vector, (select vector from emb where id = 7)) as d from emb)
order by d, id limit 5"""

# The buckets of every table by the same rule (md5 of table_projection_place), then all pairs that share one.
SQL["lsh_neighbours"] = f"""
with e as (
  select row_number() over () as r, vec_id as id, list_transform(embedding, lambda x: x::double) as v from embeddings
  where vec_id is not null and len(embedding) > 0 and len(list_filter(embedding, lambda x: x is null or not isfinite(x::double))) = 0),
dim as (select len(v) as d from e group by 1 order by count(*) desc, 1 limit 1),
a as (
  select t, m, list((('0x' || substr(md5(concat_ws('_', t, m, j)), 1, 4))::bigint - 32768) * (sqrt(3) / 32768) order by j) as a
  from range({N.TABLES}) t(t), range({N.PROJECTIONS}) m(m), (select unnest(range(d)) as j from dim) group by t, m),
h as materialized (
  select e.r, a.t, string_agg(floor(list_inner_product(e.v, a.a) / {N.BUCKET_LENGTH})::bigint::varchar, ',' order by a.m) as bucket
  from e join dim on len(e.v) = d, a group by e.r, a.t),
p as (select distinct x.r, y.r as other from h x join h y on x.t = y.t and x.bucket = y.bucket and x.r <> y.r),
n as (
  select x.id, y.id as neighbour, list_distance(x.v, y.v) as distance,
    row_number() over (partition by p.r order by list_distance(x.v, y.v), y.id, p.other) as rank
  from p join e x on x.r = p.r join e y on y.r = p.other)
select id, rank::integer as rank, neighbour, round(distance, 6) as distance from n where rank <= {S.LSH_NEIGHBOURS}
"""

# --- scoring and metrics -------------------------------------------------------------------------
SCORED = """
scored as (
  select userId, movieId, timestamp, l_orderkey, l_linenumber, l_suppkey, l_extendedprice,
         round(1.0 / (1.0 + exp(-(((movieId % 11) - 5 + (userId % 7) - 3 + rating) / 4.0))), 6) as p,
         case when rating >= 3.5 then 1 else 0 end as label
  from ratings)"""
_SCORED = with_ctes(SCORED)
SQL["scored_preview"] = _SCORED + """
select userId, timestamp, l_orderkey, l_linenumber, movieId, l_suppkey, l_extendedprice,
       concat(format('{:,.2f}', round(p * 100, 9)), '%') as predicted,
       case when label = 1 then 'Good Rating' else 'Bad Rating' end as actual
from scored order by userId, timestamp, l_orderkey, l_linenumber, movieId, l_suppkey, l_extendedprice limit 12"""
_LL = "avg(-(label * ln(least(greatest(p, 1e-7), 1 - 1e-7)) + (1 - label) * ln(1 - least(greatest(p, 1e-7), 1 - 1e-7))))"
_ACC = "avg(case when (p > 0.5)::integer = label then 1 else 0 end)"
SQL["eval_log_loss"] = _SCORED + f"select round({_LL}, 9) as log_loss from scored"
SQL["eval_accuracy"] = _SCORED + f"select round({_ACC}, 9) as accuracy from scored"
AREAS = """
g as (select p as score, sum(label)::double as pos, sum(1 - label)::double as neg from scored group by p),
c as (select *, coalesce(sum(pos) over (order by score desc rows between unbounded preceding and 1 preceding), 0) as pos_above,
                coalesce(sum(neg) over (order by score desc rows between unbounded preceding and 1 preceding), 0) as neg_above
      from g),
pr as (select *, (pos_above + pos) / (pos_above + pos + neg_above + neg) as prec,
              case when pos_above + neg_above > 0 then pos_above / (pos_above + neg_above)
                   else (pos_above + pos) / (pos_above + pos + neg_above + neg) end as prev_prec from c),
areas as (select sum(neg * (pos_above + pos / 2)) / (sum(pos) * sum(neg)) as roc_auc,
                 sum(pos * (prec + prev_prec) / 2) / sum(pos) as pr_auc from pr)"""
_AREAS = with_ctes(SCORED, AREAS)
SQL["eval_roc_auc"] = _AREAS + "select round(roc_auc, 9) as roc_auc from areas"
SQL["eval_pr_auc"] = _AREAS + "select round(pr_auc, 9) as pr_auc from areas"
SQL["eval_summary"] = _AREAS + f"""
select round({_LL}, 9) as log_loss, round({_ACC}, 9) as accuracy,
       (select round(roc_auc, 9) from areas) as roc_auc, (select round(pr_auc, 9) from areas) as pr_auc
from scored"""
