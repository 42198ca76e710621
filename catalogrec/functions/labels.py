"""Category, period and display-value rules."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .text import _col, first_segment, is_blank, lookup_key, strip

# Raw category (lower case) -> macro genre.
CATEGORY_GENRES = {
    "fiction": "fiction",
    "novels": "fiction",
    "classics": "fiction",
    "historical fiction": "fiction",
    "contemporary": "fiction",
    "literary fiction": "fiction",
    "womens fiction": "fiction",
    "adult fiction": "fiction",
    "short stories": "fiction",
    "fantasy": "fantasy_scifi",
    "science fiction": "fantasy_scifi",
    "paranormal": "fantasy_scifi",
    "urban fantasy": "fantasy_scifi",
    "science fiction fantasy": "fantasy_scifi",
    "high fantasy": "fantasy_scifi",
    "epic fantasy": "fantasy_scifi",
    "supernatural": "fantasy_scifi",
    "dystopia": "fantasy_scifi",
    "mystery": "mystery_thriller",
    "thriller": "mystery_thriller",
    "crime": "mystery_thriller",
    "suspense": "mystery_thriller",
    "true crime": "mystery_thriller",
    "detective": "mystery_thriller",
    "romance": "romance",
    "historical romance": "romance",
    "paranormal romance": "romance",
    "chick lit": "romance",
    "new adult": "romance",
    "m m romance": "romance",
    "horror": "horror",
    "vampires": "horror",
    "ghost": "horror",
    "gothic": "horror",
    "young adult": "young_adult",
    "young adult fiction": "young_adult",
    "young adult nonfiction": "young_adult",
    "juvenile fiction": "young_adult",
    "juvenile nonfiction": "young_adult",
    "childrens": "young_adult",
    "children's fiction": "young_adult",
    "picture books": "young_adult",
    "middle grade": "young_adult",
    "teen": "young_adult",
    "history": "history_biography",
    "historical": "history_biography",
    "biography & autobiography": "history_biography",
    "biography": "history_biography",
    "memoir": "history_biography",
    "autobiography": "history_biography",
    "science": "science_academic",
    "medical": "science_academic",
    "technology & engineering": "science_academic",
    "computers": "science_academic",
    "mathematics": "science_academic",
    "psychology": "science_academic",
    "social science": "science_academic",
    "political science": "science_academic",
    "education": "science_academic",
    "language arts & disciplines": "science_academic",
    "study aids": "science_academic",
    "law": "science_academic",
    "nature": "science_academic",
    "business & economics": "science_academic",
    "reference": "science_academic",
    "foreign language study": "science_academic",
    "cooking": "lifestyle",
    "health & fitness": "lifestyle",
    "self-help": "lifestyle",
    "self help": "lifestyle",
    "family & relationships": "lifestyle",
    "sports & recreation": "lifestyle",
    "crafts & hobbies": "lifestyle",
    "house & home": "lifestyle",
    "pets": "lifestyle",
    "gardening": "lifestyle",
    "games": "lifestyle",
    "travel": "lifestyle",
    "antiques & collectibles": "lifestyle",
    "body": "lifestyle",
    "games & activities": "lifestyle",
    "religion": "spirituality_philosophy",
    "christian": "spirituality_philosophy",
    "christian fiction": "spirituality_philosophy",
    "bibles": "spirituality_philosophy",
    "philosophy": "spirituality_philosophy",
    "spirituality": "spirituality_philosophy",
    "art": "arts_poetry",
    "photography": "arts_poetry",
    "performing arts": "arts_poetry",
    "music": "arts_poetry",
    "poetry": "arts_poetry",
    "drama": "arts_poetry",
    "plays": "arts_poetry",
    "literary criticism": "arts_poetry",
    "literary collections": "arts_poetry",
    "design": "arts_poetry",
    "architecture": "arts_poetry",
    "comics": "sequential_art",
    "graphic novels": "sequential_art",
    "manga": "sequential_art",
    "comics & graphic novels": "sequential_art",
    "sequential art": "sequential_art",
    "humor": "humor",
}

# Labels shown for missing or early values.
UNKNOWN_GENRE = "unknown"
OTHER_GENRE = "other"
UNCLASSIFIED_LABEL = "Genre non classé"
UNKNOWN_PERIOD = "Inconnue"
EARLY_PERIOD = "Avant 1900"
MISSING_VALUE = "N/A"


def genre_table(spark: SparkSession, mapping: dict[str, str] | None = None) -> DataFrame:
    """The category dictionary as a two-column dimension table."""
    cells = [F.lit(text) for pair in (mapping or CATEGORY_GENRES).items() for text in pair]
    return spark.range(1).select(F.explode(F.create_map(*cells)).alias("category", "genre"))


def with_genre(
    df: DataFrame,
    raw: str = "genres_raw",
    out: str = "genre_clean",
    mapping: dict[str, str] | None = None,
) -> DataFrame:
    """Add the macro genre of the first comma segment: null/blank -> unknown, no match -> other.

    The dictionary is a literal of this code, so its broadcast does not grow with the data.
    """
    table = genre_table(df.sparkSession, mapping).withColumnsRenamed(
        {"category": "_category", "genre": "_genre"}
    )
    keyed = df.withColumn("_category", lookup_key(first_segment(raw)))
    genre = F.when(is_blank(raw), F.lit(UNKNOWN_GENRE)).otherwise(
        F.coalesce("_genre", F.lit(OTHER_GENRE))
    )
    return (
        keyed.join(F.broadcast(table), "_category", "left")
        .withColumn(out, genre)
        .drop("_category", "_genre")
    )


def period_bucket(year: Column | str) -> Column:
    """Decade label of a publication year."""
    whole = _col(year).cast("double").try_cast("long")
    decade = F.concat((F.floor(whole / 10) * 10).cast("long").cast("string"), F.lit("s"))
    return (
        F.when(whole.isNull(), F.lit(UNKNOWN_PERIOD))
        .when(whole < 1900, F.lit(EARLY_PERIOD))
        .otherwise(decade)
    )


def format_number(c: Column | str, suffix: str = "") -> Column:
    """Display text of a double: missing -> N/A, whole numbers without a fraction."""
    v = _col(c).cast("double")
    size = F.abs(v)
    exact = F.regexp_replace(v.try_cast("decimal(38,15)").cast("string"), r"0+\z", "")
    plain = (size >= 1e-4) & (size < 1e16) & ((size < 1e-3) | (size >= 1e7))
    text = (
        F.when((v == F.floor(v)) & (size < 1e18), v.try_cast("long").cast("string"))
        .when(plain, exact)
        .otherwise(v.cast("string"))
    )
    missing = v.isNull() | F.isnan(v)
    return F.when(missing, F.lit(MISSING_VALUE)).otherwise(F.concat(text, F.lit(suffix)))


def format_text(c: Column | str, suffix: str = "") -> Column:
    """Display text of a string: null, blank and ``nan`` -> N/A."""
    text = strip(c)
    missing = text.isNull() | (text == "") | (F.lower(text) == "nan")
    return F.when(missing, F.lit(MISSING_VALUE)).otherwise(F.concat(text, F.lit(suffix)))


def format_genre(c: Column | str) -> Column:
    """Readable genre name: underscores as spaces, title case."""
    genre = _col(c)
    missing = genre.isNull() | genre.isin("", UNKNOWN_GENRE, OTHER_GENRE)
    readable = F.initcap(F.replace(genre, F.lit("_"), F.lit(" ")))
    return F.when(missing, F.lit(UNCLASSIFIED_LABEL)).otherwise(readable)
