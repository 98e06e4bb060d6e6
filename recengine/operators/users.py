"""Leak-free per-user history features.

All features share ONE window partitioning — the previous ``frame`` ratings of the same user, current row
excluded — so the plan has one Exchange on the user key and one Sort. Sums over the frame are differences of
running sums: the sum before the row minus the sum before the row ``frame`` places above it, so a row costs the
same whatever the frame. Ratings in halves and years are summed exactly (their sums and squares have exact doubles).
The genres of liked movies are counted in the same way: a movie has a number for every ``FIELDS`` genres of the
vocabulary, each genre in a field of ``FIELD_BITS`` bits, and those numbers are summed. Hot users are split
by :func:`recengine.operators.ordering.frame_groups` (exact: halo rows give every chunk its look-back).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from recengine import schemas as S
from recengine.functions.arrays import flat_sorted, rank_sorted_by_frequency
from recengine.functions.columns import two_decimals
from recengine.operators.joins import DEFAULT_BROADCAST_ROWS, MAX_BROADCAST_BYTES, table_bytes
from recengine.operators.movies import add_movie_features, fill_movie_columns
from recengine.operators.ordering import DEFAULT_HOT_ROWS, HotKeys, frame_groups, total_order

#: Genres of one packed number and bits of each. A sum of 2**21 rows of three equal genres still fits a long, and a
#: frame's count fits a field; groups of a window have at most ``hot_threshold`` rows and a halo.
FIELDS, FIELD_BITS = 3, 20
#: Larger vocabularies, and larger window groups, are ranked from the frame's lists of genres.
MOST_GENRES, MOST_ROWS = 60, 1 << 21
ODD = float("nan")


def genre_vocabulary(genres: DataFrame) -> list[str] | None:
    """The different genres of a column ``genres`` of |-separated names, sorted; None if they are too many to pack."""
    names = genres.select(F.explode(F.split("genres", r"\|")).alias("g")).distinct().limit(MOST_GENRES + 1).collect()
    return sorted((r["g"] for r in names), key=lambda g: g.encode()) if len(names) <= MOST_GENRES else None


def packed_genres(genres, vocabulary: list[str]) -> dict[str, "F.Column"]:
    """``_g0``, ``_g1``, ...: the counts of a movie's genres, FIELDS of them in each number."""
    def number(names: list[str]) -> "F.Column":
        field = F.create_map(*[F.lit(x) for i, g in enumerate(names) for x in (g, 1 << (FIELD_BITS * i))])
        total = F.aggregate(F.split(genres, r"\|"), F.lit(0).cast("bigint"),
                            lambda sum_, g: sum_ + F.coalesce(F.try_element_at(field, g).cast("bigint"), F.lit(0).cast("bigint")))
        return F.coalesce(total, F.lit(0).cast("bigint"))

    return {f"_g{k}": number(vocabulary[at:at + FIELDS]) for k, at in enumerate(range(0, len(vocabulary), FIELDS))}


def top_genres(vocabulary: list[str]):
    """The genres by falling count, then by name, as count * 64 + 63 - place in the vocabulary; below 64 one is absent.

    One lambda over the packed numbers: an expression for each genre would make a method that is too long for the JVM's
    compiler, and a lambda over the places would build their array at each. ``sort_array`` compares numbers
    natively; ``array_sort`` would call a lambda for every comparison.
    """
    packs = ", ".join(f"_g{k}" for k in range(-(-len(vocabulary) // FIELDS)))
    counts = (f"(shiftright(p, {FIELD_BITS * i}) & {(1 << FIELD_BITS) - 1}) * 64 + {63 - i} - {FIELDS} * k" for i in range(FIELDS))
    return F.sort_array(F.expr(f"flatten(transform(array({packs}), (p, k) -> array({', '.join(counts)})))"), asc=False)


def history_window(order: list[str], frame: int = S.HISTORY_FRAME, salted: bool = True):
    parts = ["userId", "_chunk"] if salted else ["userId"]
    return Window.partitionBy(*parts).orderBy(*order).rowsBetween(-frame, -1)


def running_columns(packed: list[str]) -> dict[str, "F.Column"]:
    """What is summed: rows, finite ratings and years with their squares, other ratings, genres of liked movies."""
    rating = F.col("rating").cast("double")
    fine = rating.isNotNull() & ~F.isnan(rating) & (F.abs(rating) < F.lit(float("inf")))
    r = F.when(fine, rating).otherwise(F.lit(0.0))
    year = F.col("releaseYear").cast("bigint")
    liked = F.col("label") == 1
    return {"_n": F.lit(1).cast("bigint"), "_rn": fine.cast("bigint"), "_r": r, "_rr": r * r,
            "_odd": (rating.isNotNull() & ~fine).cast("bigint"), "_yn": year.isNotNull().cast("bigint"),
            "_y": F.coalesce(year, F.lit(0)), "_yy": F.coalesce(year * year, F.lit(0).cast("bigint")),
            **{g: F.when(liked, F.col(g)).otherwise(F.lit(0).cast("bigint")) for g in packed}}


def over_frame(df: DataFrame, sums: dict[str, "F.Column"], lists: dict[str, "F.Column"], order: list[str], frame: int) -> DataFrame:
    """Adds the frame's sums and lists; two windows over one sort."""
    parts = Window.partitionBy("userId", "_chunk").orderBy(*order)
    before = parts.rowsBetween(Window.unboundedPreceding, -1)
    df = df.withColumns(sums)
    df = df.select("*", *[F.coalesce(F.sum(c).over(before), F.lit(0)).alias(f"{c}_") for c in sums],
                   *[c.over(history_window(order, frame)).alias(k) for k, c in lists.items()]).drop(*sums)
    return df.withColumns({c: F.col(f"{c}_") - F.lag(f"{c}_", frame, 0).over(parts) for c in sums}).drop(*[f"{c}_" for c in sums])


def mean(total: str, n: str):
    return F.when(F.col(n) > 0, F.col(total) / F.col(n))


def deviation(squares: str, total: str, n: str):
    """Sample deviation from sums; null below two values."""
    total, n = F.col(total).cast("double"), F.col(n)
    return F.when(n > 1, F.sqrt(F.greatest(F.col(squares) - total * total / n, F.lit(0.0)) / (n - 1)))


def user_feature_columns(slots: int = S.HISTORY_SLOTS, vocabulary: list[str] | None = None) -> dict[str, "F.Column"]:
    """Final columns from the frame's sums, ``_hist`` and ``_top`` (ranked genres, or with a vocabulary ``top_genres``)."""
    cols = {f"userRatedMovie{i + 1}": F.get(F.col("_hist"), F.size("_hist") - 1 - i) for i in range(slots)}
    of_ratings = lambda c: F.when(F.col("_odd") > 0, F.lit(ODD)).otherwise(c)
    cols["userRatingCount"] = F.col("_n")
    cols["userAvgReleaseYear"] = F.coalesce(mean("_y", "_yn").cast("int"), F.lit(0))
    cols["userReleaseYearStddev"] = two_decimals(F.coalesce(deviation("_yy", "_y", "_yn"), F.lit(0.0)))
    cols["userAvgRating"] = two_decimals(of_ratings(mean("_r", "_rn")))
    cols["userRatingStddev"] = two_decimals(F.coalesce(of_ratings(deviation("_rr", "_r", "_rn")), F.lit(0.0)))
    names = F.array(*[F.lit(g) for g in vocabulary]) if vocabulary else F.lit(None).cast("array<string>")
    for i in range(slots):
        place = F.get(F.col("_top"), i)
        cols[f"userGenre{i + 1}"] = place if vocabulary is None else F.when(
            place >= 64, F.get(names, (F.lit(63) - place.bitwiseAND(F.lit(63))).cast("int")))
    return cols


def add_user_features(samples: DataFrame, order: list[str] | None = None, frame: int = S.HISTORY_FRAME,
                      min_prior: int = S.MIN_PRIOR_RATINGS, hot_threshold: int = DEFAULT_HOT_ROWS,
                      chunk_rows: int | None = None, keep: list[str] | None = None,
                      hot: HotKeys | None = None, movie_columns: DataFrame | None = None,
                      vocabulary: list[str] | None = None) -> DataFrame:
    """Samples with movie features -> the 28-column feature sample.

    ``order``: order key inside a user (timestamp first); movie and rating are appended as tie-breakers, so
    rows that still tie are equal in all that a history shows. ``keep``: extra input columns to carry (e.g. tie-breakers).
    ``hot``: hot users found by the caller (e.g. on the plain ratings, which have the same rows per
    user as the joined samples but skip the movie joins). ``movie_columns``: a small per-movie table whose
    columns are joined after the window instead of being carried through it. ``vocabulary``: all genres that occur
    (see :func:`genre_vocabulary`), sorted; the samples may have the packed counts already. Without one
    the frame's lists of genres are ranked.
    """
    order = total_order(order, samples.columns)
    packs = vocabulary is not None and max(hot_threshold, chunk_rows or 0) + frame <= MOST_ROWS
    packed = []
    if packs:
        if vocabulary and "_g0" not in samples.columns:
            samples = samples.withColumns(packed_genres("genres", vocabulary))
        packed = [c for c in samples.columns if c.startswith("_g") and c[2:].isdigit()]
    else:  # genres are split once per rating, not for every row whose history shows them
        samples = samples.withColumn("_genres", F.split("genres", r"\|"))
    samples = samples.drop("genres")
    grouped = frame_groups(samples, "userId", order, frame, hot_threshold, chunk_rows, hot)
    base = [c for c in S.SAMPLE_COLUMNS if c in samples.columns]
    extra = [c for c in (keep or []) if c not in base]
    liked = F.col("label") == 1
    lists = {"_hist": F.collect_list(F.when(liked, F.col("movieId")))}
    if not packs:
        lists["_gl"] = F.collect_list(F.when(liked, F.col("_genres")))
    sums = running_columns(packed)
    needed = dict.fromkeys([*base, *extra, "_halo", "_chunk", "_pos", *order, *packed, *(["_genres"] if not packs else [])])
    win = over_frame(grouped.select(*needed), sums, lists, ["_pos", *order], frame)
    # filter right above the Window: halo copies and rows with too short a history go first
    win = win.where(~F.col("_halo") & (F.col("_n") > min_prior))
    if packs:
        ranked = win.withColumn("_top", top_genres(vocabulary) if vocabulary else F.array().cast("array<bigint>"))
    else:  # genre ranking in steps, each array materialised once per row
        ranked = (win.withColumn("_s", flat_sorted("_gl"))
                     .withColumn("_rs", F.reverse("_s"))
                     .withColumn("_top", rank_sorted_by_frequency("_s", "_rs")))
    feats = user_feature_columns(vocabulary=vocabulary if packs else None)
    late = [c for c in S.SAMPLE_COLUMNS if c not in feats and c not in base]
    if movie_columns is not None:
        ranked = fill_movie_columns(ranked.join(F.broadcast(movie_columns.select("movieId", *late)), "movieId", "left"))
    return ranked.select(*[feats[c].alias(c) if c in feats else F.col(c) for c in S.SAMPLE_COLUMNS], *extra)


def sample_features(labeled: DataFrame, table: DataFrame, max_broadcast_bytes: int = MAX_BROADCAST_BYTES,
                    **options) -> DataFrame:
    """Labelled ratings and the per-movie table -> the 28-column feature sample.

    Where the table can be broadcast (by its measured bytes) and holds each movie once, only the year and the genres go
    through the window; titles, genre slots and statistics are joined after it. Else the ratings are joined once before.
    """
    vocabulary = genre_vocabulary(table)
    packed = packed_genres("genres", vocabulary) if vocabulary else {}
    through = [] if vocabulary is not None else ["genres"]  # genres that aren't packed are ranked as names
    small = table.select("movieId", *through, "releaseYear", *[c.alias(k) for k, c in packed.items()])
    late = table.select("movieId", *[c for c in S.SAMPLE_COLUMNS if c in table.columns and c not in small.columns])
    repeated = table.groupBy("movieId").count().where("count > 1").limit(1).count()
    if repeated or max(table_bytes(small), table_bytes(late)) > max_broadcast_bytes:
        rows = DEFAULT_BROADCAST_ROWS if max_broadcast_bytes >= MAX_BROADCAST_BYTES else 0
        return add_user_features(add_movie_features(labeled, None, rows, table=table), vocabulary=vocabulary, **options)
    small = table.select("movieId", "genres", "releaseYear", *[c.alias(k) for k, c in packed.items()])
    narrow = labeled.join(F.broadcast(small), "movieId", "left")
    narrow = narrow.withColumns({k: F.coalesce(F.col(k), F.lit(0).cast("bigint")) for k in packed}) if packed else narrow
    return add_user_features(fill_movie_columns(narrow), movie_columns=table, vocabulary=vocabulary, **options)
