"""The post table, the place dimension and the other fixed inputs."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

# Metrics arrive as text ("12", "N/A", null); see functions.metrics for the casts.
POST_SCHEMA = T.StructType(
    [
        T.StructField("post_id", T.LongType()),
        T.StructField("text", T.StringType()),
        T.StructField("ts", T.TimestampType()),
        T.StructField("author_id", T.LongType()),
        T.StructField("likes", T.StringType()),
        T.StructField("retweets", T.StringType()),
        T.StructField("replies", T.StringType()),
        T.StructField("quotes", T.StringType()),
        T.StructField("username", T.StringType()),
        T.StructField("followers", T.StringType()),
        T.StructField("following", T.StringType()),
        T.StructField("total_posts", T.StringType()),
        T.StructField("lang", T.StringType()),
    ]
)

# CSV header name of each post column.
CSV_HEADER = {
    "post_id": "Tweet_ID",
    "text": "Text",
    "ts": "Timestamp",
    "author_id": "Author_ID",
    "likes": "Likes",
    "retweets": "Retweets",
    "replies": "Replies",
    "quotes": "Quotes",
    "username": "Username",
    "followers": "Followers",
    "following": "Following",
    "total_posts": "Total_Tweets",
    "lang": "Lang",
}

METRICS = ["likes", "retweets", "replies", "quotes"]
CHART_METRICS = ["likes", "retweets", "replies"]

MISSING = "N/A"

# Hashtags of the standard search, compared in lower case.
SEARCH_HASHTAGS = [
    "technology",
    "tech",
    "ai",
    "artificialintelligence",
    "machinelearning",
    "datascience",
    "programming",
    "entertainment",
    "celebrity",
    "popculture",
    "music",
    "tvshow",
    "gossip",
    "trending",
    "business",
    "sports",
    "finance",
]

# Hashtag, place name, latitude, longitude.
PLACES = [
    ("#NYC", "New York City", 40.7128, -74.0060),
    ("#LosAngeles", "Los Angeles", 34.0522, -118.2437),
    ("#SanFrancisco", "San Francisco", 37.7749, -122.4194),
    ("#Chicago", "Chicago", 41.8781, -87.6298),
    ("#Houston", "Houston", 29.7604, -95.3698),
    ("#Miami", "Miami", 25.7617, -80.1918),
    ("#Boston", "Boston", 42.3601, -71.0589),
    ("#Seattle", "Seattle", 47.6062, -122.3321),
    ("#Dallas", "Dallas", 32.7767, -96.7970),
    ("#Atlanta", "Atlanta", 33.7490, -84.3880),
    ("#London", "London", 51.5074, -0.1278),
    ("#Manchester", "Manchester", 53.4808, -2.2426),
    ("#Birmingham", "Birmingham", 52.4862, -1.8904),
    ("#Delhi", "Delhi", 28.6139, 77.2090),
    ("#Mumbai", "Mumbai", 19.0760, 72.8777),
    ("#Bombay", "Mumbai", 19.0760, 72.8777),
    ("#Hyderabad", "Hyderabad", 17.3850, 78.4867),
    ("#Bangalore", "Bangalore", 12.9716, 77.5946),
    ("#Bengaluru", "Bangalore", 12.9716, 77.5946),
    ("#Mangalore", "Mangalore", 12.9141, 74.8560),
    ("#Chennai", "Chennai", 13.0827, 80.2707),
    ("#Pune", "Pune", 18.5204, 73.8567),
    ("#Kolkata", "Kolkata", 22.5726, 88.3639),
    ("#Ahmedabad", "Ahmedabad", 23.0225, 72.5714),
    ("#Vizag", "Visakhapatnam", 17.6868, 83.2185),
    ("#Jaipur", "Jaipur", 26.9124, 75.7873),
    ("#Lucknow", "Lucknow", 26.8467, 80.9462),
    ("#Chandigarh", "Chandigarh", 30.7333, 76.7794),
    ("#Coimbatore", "Coimbatore", 11.0168, 76.9558),
    ("#Paris", "Paris", 48.8566, 2.3522),
    ("#Berlin", "Berlin", 52.5200, 13.4050),
    ("#Rome", "Rome", 41.9028, 12.4964),
    ("#Madrid", "Madrid", 40.4168, -3.7038),
    ("#Barcelona", "Barcelona", 41.3784, 2.1925),
    ("#Zurich", "Zurich", 47.3769, 8.5417),
    ("#Amsterdam", "Amsterdam", 52.3676, 4.9041),
    ("#Athens", "Athens", 37.9838, 23.7275),
    ("#Helsinki", "Helsinki", 60.1695, 24.9354),
    ("#Tokyo", "Tokyo", 35.6762, 139.6503),
    ("#Seoul", "Seoul", 37.5665, 126.9780),
    ("#Singapore", "Singapore", 1.3521, 103.8198),
    ("#Bangkok", "Bangkok", 13.7563, 100.5018),
    ("#KualaLumpur", "Kuala Lumpur", 3.1390, 101.6869),
    ("#Jakarta", "Jakarta", -6.2088, 106.8456),
    ("#Dubai", "Dubai", 25.276987, 55.296249),
    ("#Istanbul", "Istanbul", 41.0082, 28.9784),
    ("#Cairo", "Cairo", 30.0444, 31.2357),
    ("#CapeTown", "Cape Town", -33.9249, 18.4241),
    ("#Lagos", "Lagos", 6.5244, 3.3792),
    ("#BuenosAires", "Buenos Aires", -34.6037, -58.3816),
    ("#Rio", "Rio de Janeiro", -22.9068, -43.1729),
    ("#SaoPaulo", "Sao Paulo", -23.5505, -46.6333),
    ("#MexicoCity", "Mexico City", 19.4326, -99.1332),
    ("#Toronto", "Toronto", 43.6532, -79.3832),
    ("#Vancouver", "Vancouver", 49.2827, -123.1207),
    ("#Moscow", "Moscow", 55.7558, 37.6173),
    ("#India", "India", 20.5937, 78.9629),
    ("#USA", "USA", 37.0902, -95.7129),
    ("#UK", "United Kingdom", 55.3781, -3.4360),
    ("#Europe", "Europe", 54.5260, 15.2551),
    ("#Asia", "Asia", 34.0479, 100.6197),
]

PLACE_SCHEMA = "tag string, place string, lat double, lon double"

# The small built-in polarity lexicon and lemma dictionary. Both are
# defaults only; callers pass larger tables of the same shape.
LEXICON = [("great", 0.8), ("good", 0.7), ("bad", -0.7), ("terrible", -1.0)]
LEMMAS = [("posts", "post"), ("cities", "city"), ("mice", "mouse"), ("tags", "tag")]
NEGATORS = ["not", "no", "never"]

# Endings of English plural nouns and what takes their place, in the order they
# are tried, and irregular forms. Callers may pass their own.
NOUN_ENDINGS = [
    ("ses", "s"),
    ("ves", "f"),
    ("xes", "x"),
    ("zes", "z"),
    ("ches", "ch"),
    ("shes", "sh"),
    ("men", "man"),
    ("ies", "y"),
    ("s", ""),
]
LEMMA_EXCEPTIONS = [
    ("children", "child"),
    ("feet", "foot"),
    ("geese", "goose"),
    ("mice", "mouse"),
    ("teeth", "tooth"),
]


def places(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(PLACES, PLACE_SCHEMA)


def lexicon(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(LEXICON, "word string, polarity double")


def lemmas(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(LEMMAS, "form string, lemma string")


def stopwords(language: str = "english") -> list[str]:
    """Spark's own stop-word list; needs an active session."""
    from pyspark.ml.feature import StopWordsRemover

    return list(StopWordsRemover.loadDefaultStopWords(language))
