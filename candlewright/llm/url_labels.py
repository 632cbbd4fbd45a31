"""The small labelled table of urls that the url filter learns from by default.

Only urls of the table are learnt; nothing is said of any other. Users with labels of their own pass them to
``url_filter.train`` in place of these.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

# Names of unwanted hosts by kind, and of hosts that are wanted. Invented, in the usual wordings.
UNWANTED = {
    "spam": ["spam-farm", "link-farm", "seo-spam", "spam-blog", "content-farm", "click-farm", "bulk-mail", "mail-spam", "backlink-farm", "spamdomain"],
    "pills": ["cheap-pills", "buy-pills", "pills-online", "cheap-meds", "diet-pills", "pharma-cheap", "viagra-shop", "meds-express", "discount-pharmacy", "pillstore"],
    "casino": ["casino-win", "online-casino", "casino-royal", "poker-win", "jackpot-slots", "slots-casino", "mega-casino", "win-casino", "roulette-win", "casinobonus"],
    "bets": ["free-bets", "sport-bets", "bets-online", "best-bets", "bet-now", "betting-tips", "live-bets", "bonus-bets", "football-bets", "betsoffice"],
    "advertising": ["ads-track", "track-ads", "ad-tracker", "ads-server", "banner-ads", "adclick-track", "popup-ads", "ads-pixel", "pixel-track", "adsnetwork"],
    "adult": ["adult-x", "adult-cams", "xxx-adult", "x-videos", "adult-dating", "sexy-cams", "hot-adult", "adult-chat", "porn-x", "adultvideos"],
}
WANTED = [
    "library", "university", "museum", "weather", "recipes", "gardening", "astronomy", "history", "physics", "chemistry", "townhall", "railway", "cycling", "hiking-club",
    "newspaper", "daily-news", "science-journal", "open-data", "linux-docs", "python-tips", "math-forum", "book-review", "film-archive", "music-school", "city-council",
    "health-office", "hospital", "childrens-books", "language-course", "dictionary", "encyclopedia", "maps", "travel-guide", "bakery", "carpenter", "architecture",
    "bibliothek", "stadtwerke", "zeitung", "hochschule", "wetterdienst", "gemeinde", "mairie", "musee", "biblioteca", "universidad", "noticias", "journal", "cuisine", "theatre",
    "tionsh", "tionble", "thering", "thered", "theren", "ththan", "ththou", "ththing", "therwh", "thernd", "ableson", "winter-sports", "betterdays", "tracking-trails", "adsorption", "address-book",
]
BEFORE, AFTER, PATHS = ("", "www.", "m.", "blog."), (".com", ".org", ".net"), ("/", "/en/2041", "/de/77.html", "/fr/530/")


def rows(names: list[str], label: int) -> list[tuple[str, str, str, int]]:
    """Three urls a name, whose other parts go round, so that they say nothing of the label."""
    return [
        (n, BEFORE[(i + k) % 4] + n + ("", ".example")[(i + k) % 2] + AFTER[(i + 2 * k) % 3], PATHS[(i + 3 * k) % 4], label) for i, n in enumerate(names) for k in range(3)
    ]


def table() -> list[tuple[str, str, str, int]]:
    """(name, host, path, label), label 1 for unwanted urls."""
    return [r for names in UNWANTED.values() for r in rows(names, 1)] + rows(WANTED, 0)


def labelled(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(table(), "name string, host string, path string, label int").select("host", "path", "label")
