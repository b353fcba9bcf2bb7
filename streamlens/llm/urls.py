"""URL filters: rules for known hosts, and a classifier of host and path for all others.

The classifier is a logistic regression on hashed character n-grams of 3 to 5 characters,
those of the host apart from those of the path, fitted on a small labelled table of URLs.
Digits count as one character, so numbers of pages teach nothing.  Weights have a fixed number
of places and go to the rows; no row is shuffled, so a hot host costs nothing.

Defined results: the host stands between the first ``://`` and the next ``/``, ``?``, ``#`` or
the end, A to Z lower-cased; the path reaches to the next ``?``, ``#`` or the end.  A null URL, or
one without ``://``, has an empty host and path; they have no n-grams, so the intercept decides.
A rule fits its host and all hosts below it if the path starts with its path, so an empty path
fits no rule that ends in ``/``.  The longest rule wins, of equally long ones the first by code
points.  Repeated rows are judged alike, each on its own; an empty table gives no rows.  Columns
of the input that are no result keep their names and values.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.ml.classification import LogisticRegression, LogisticRegressionModel
from pyspark.ml.feature import HashingTF, NGram, Normalizer
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Sizes of the n-grams, places they are hashed to, and the penalty of the fit.
GRAMS = (3, 4, 5)
PLACES = 1 << 16
PENALTY = 0.0001
#: A URL goes only if the model is rather sure.
THRESHOLD = 0.6

# Fixed values: (verdict, host, path).
RULES = (
    ("allow", "org", "/"),
    ("block", "example.org", "/es/"),
    ("block", "example.org", "/en/1"),
    ("allow", "com", "/fr/"),
    ("block", "com", "/de/"),
)

# The small labelled table, made up by hand: hosts and paths that are to be blocked, and not.
# Languages and common first names of hosts stand in both, as they tell nothing.
BLOCKED = """
best-casino-bonus.example/slots/ casino.royal.example/play/free-spins www.casino-jackpot.example/roulette
m.lucky-casino.example/poker/table live-casino-games.example/en/blackjack win-big-casino.example/win/now
online-slots-win.example/slots/jackpot jackpot-winner.example/claim poker-stars-club.example/bets
free-bet-tips.example/odds sport-bets-daily.example/bets/football www.bets-and-odds.example/betting/live
bet-now.example/en/free-bets betting-bonus.example/signup m.betting-king.example/en/odds
buy-cheap-pills.example/viagra cheap-meds-online.example/en/pills www.pills-without-prescription.example/order
diet-pills-fast.example/weight-loss generic-pharma-pills.example/fr/cialis cheap-drugs.example/buy/tramadol
pharmacy-discount-pills.example/shop cheap-replica-watches.example/de/buy cheap-handbags-outlet.example/sale
adult-video-chat.example/cams adults-only.example/en/xxx/videos www.adult-dating-now.example/meet
free-adult-movies.example/xxx xxx-tube.example/video/ hot-cams-live.example/en/chat
sexy-singles-dating.example/join porn-clips.example/watch escort-girls-city.example/adult
adult-x-rated.example/gallery nude-cams.example/es/live m.adult-toys-shop.example/sale
spam-links.example/en/seo link-farm-exchange.example/backlinks buy-backlinks-seo.example/spam
spammy-directory.example/en/submit www.seo-spam-network.example/links content-farm-spam.example/en/article/
link-farm.example/en/page article-farm-seo.example/spin ads-network.example/en/click
ads-tracker.example/pixel.gif blog.click-track.example/en/ads/redirect banner-ads-server.example/track
pop-up-ads.example/click?id adserver-tracking.example/ads.js m.tracking-pixel.example/fr/track
www.track-and-click.example/ads malware-download.example/crack.exe free-warez-crack.example/en/keygen
serial-keygen.example/crack torrent-warez.example/download free-download-crack.example/exe
payday-loans-fast.example/apply instant-cash-loans.example/en/payday bad-credit-loans.example/loan/apply
make-money-fast.example/earn blog.earn-cash-home.example/es/easy-money crypto-doubler.example/invest
bitcoin-profit-now.example/get-rich forex-signals-win.example/profit free-gift-cards.example/en/win
win-free-iphone.example/prize claim-your-prize.example/winner m.lottery-winner.example/en/claim/prize
blog.miracle-weight-loss.example/en/buy hair-loss-cure.example/order-now account-verify-login.example/secure/update
"""
ALLOWED = """
www.city-library.example/catalogue/books library.university.example/research/papers museum.example/exhibitions/
www.state-archive.example/collections/maps news.daily-herald.example/politics/ www.morning-news.example/world/europe
local-news.example/article/school-opening m.evening-post.example/en/economy weather.example/en/forecast/tomorrow
www.encyclopedia.example/wiki/Photosynthesis en.wiki.example/wiki/History_of_science dictionary.example/define/river
docs.database.example/en/manual/installation docs.language.example/tutorial/functions developer.example/reference/api
blog.engineering.example/posts/sorting-algorithms blog.gardening.example/growing-tomatoes blog.travels.example/en/norway
blog.mathematics.example/prime-numbers www.recipes.example/bread/sourdough cooking.example/recipes/soup
www.hospital.example/patients/visiting health.ministry.example/vaccination www.school-district.example/calendar
university.example/en/faculty/physics www.institute.example/publications/ journal.example/volume/issue/article
www.theatre.example/programme orchestra.example/concerts/season www.gallery-of-art.example/paintings/
www.city-council.example/meetings/minutes parliament.example/debates/ www.court.example/decisions/
railway.example/en/timetable www.airport.example/arrivals transport.example/bus/routes
www.football-club.example/team/history chess.example/en/openings/sicilian cycling.example/routes/alps
forum.photography.example/thread/lenses forum.woodworking.example/thread/joints m.community.example/questions/
www.bookshop.example/en/fiction/novels publishing.example/authors/ poetry.example/poems/
science.example/biology/cells astronomy.example/planets/saturn www.geology.example/minerals/quartz
www.history-society.example/articles/ heritage.example/castles/ archaeology.example/excavations/
www.software-foundation.example/projects/ opensource.example/license/ code.example/repository/readme
www.statistics-office.example/population/ economy.example/fr/reports/inflation bank.example/interest-rates
agriculture.example/crops/wheat forestry.example/trees/oak www.environment.example/rivers/
www.zoo.example/es/animals/elephants aquarium.example/fishes/ birds.example/en/species/heron
www.radio.example/programmes/ television.example/schedule film-festival.example/screenings/
music.example/en/composers/bach www.choir.example/rehearsals dance.example/lessons/
kindergarten.example/enrolment www.language-school.example/courses/french translation.example/grammar/verbs
m.restaurant.example/menu www.hotel.example/rooms hiking.example/en/trails/
www.village.example/en/churches m.theology.example/en/sermons www.philosophy.example/de/kant
www.newspaper.example/fr/culture m.magazine.example/es/viajes blog.linguistics.example/en/phonology
threads.example/en/weaving www.northern-region.example/en/ www.thermal-baths.example/en/opening-hours
erosion.example/en/coast blog.tradition.example/en/customs blog.nation.example/en/constitution
station.example/en/platforms www.thesis.example/en/abstract other.example/de/seite
thirteen.example/en/stories www.there.example/en/page blog.question.example/fr/article
"""


def host_and_path(url: Column) -> tuple[Column, Column]:
    whole = F.coalesce(url, F.lit(""))
    at = F.instr(whole, "://")
    rest = F.when(at > 0, F.substring(whole, at + 3, F.length(whole))).otherwise("")
    host = F.regexp_extract(rest, "^[^/?#]*", 0)
    return (
        F.translate(host, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"),
        F.regexp_extract(rest, "^[^/?#]*([^?#]*)", 1),
    )


def longest_rule(host: Column, path: Column, rules=RULES) -> Column:
    """The rule that fits, as ``struct(rule, verdict)``, or null."""
    ordered = sorted(rules, key=lambda r: (-len(r[1] + r[2]), r[1] + r[2]))
    fits = [
        F.when(
            ((host == h) | F.endswith(host, F.lit(f".{h}"))) & F.startswith(path, F.lit(p)),
            F.struct(F.lit(h + p).alias("rule"), F.lit(verdict).alias("verdict")),
        )
        for verdict, h, p in ordered
    ]
    none = F.lit(None).cast("struct<rule:string,verdict:string>")
    return F.coalesce(*fits, none)


def _letters(text: Column, name: str) -> Column:
    """The characters of a host or path between its bounds, marked by ``name``; none of nothing."""
    bounded = F.when(text != "", F.concat(F.lit("<"), text, F.lit(">"))).otherwise("")
    letters = F.split(F.regexp_replace(bounded, "[0-9]", "0"), "")
    return F.when(text == "", F.array().cast("array<string>")).otherwise(
        F.transform(letters, lambda c: F.concat(F.lit(name), c))
    )


def _features(df: DataFrame) -> DataFrame:
    """Adds ``__features`` for ``__host`` and ``__path``: counts of all n-grams, to length 1."""
    found, columns = df, []
    for name, column in (("h", "__host"), ("p", "__path")):
        found = found.withColumn(f"__{name}", _letters(F.col(column), name))
        for n in GRAMS:
            columns.append(f"__{name}{n}")
            found = NGram(n=n, inputCol=f"__{name}", outputCol=columns[-1]).transform(found)
    terms = found.withColumn("__grams", F.concat(*columns))
    counted = HashingTF(numFeatures=PLACES, inputCol="__grams", outputCol="__counts").transform(terms)
    return Normalizer(inputCol="__counts", outputCol="__features").transform(counted)


@dataclass(frozen=True)
class Model:
    """The fitted regression; a score of ``THRESHOLD`` or more is blocked."""

    fitted: LogisticRegressionModel

    def score(self, df: DataFrame) -> DataFrame:
        """Adds ``score``, the probability that a URL is to be blocked."""
        names = df.columns
        judged = self.fitted.transform(_features(df))
        return judged.select(*names, vector_to_array("__probability")[1].alias("score"))


def labelled(spark: SparkSession) -> DataFrame:
    """The table above: ``url, blocked``."""
    rows = [
        (f"https://{url}", blocked)
        for blocked, urls in ((1.0, BLOCKED), (0.0, ALLOWED))
        for url in urls.split()
    ]
    return spark.createDataFrame(rows, "url string, blocked double")


def train(table: DataFrame) -> Model:
    """A model of labelled URLs (``url, blocked`` 1 or 0); the table is small and one task reads it.

    Rows are put in order first, so equal tables give equal models.
    """
    host, path = host_and_path(F.col("url"))
    rows = table.select("url", "blocked", host.alias("__host"), path.alias("__path"))
    ordered = rows.coalesce(1).sortWithinPartitions("url", "blocked")
    regression = LogisticRegression(
        featuresCol="__features",
        labelCol="blocked",
        probabilityCol="__probability",
        rawPredictionCol="__raw",
        predictionCol="__prediction",
        regParam=PENALTY,
        standardization=False,
        maxIter=60,
    )
    return Model(regression.fit(_features(ordered)))


def judge(pages: DataFrame, model: Model, rules=RULES) -> DataFrame:
    """``pages`` with ``host, path, rule, verdict, score`` of their ``url``.

    ``rule`` is the longest that fits, else null; ``score`` is the model's for every row and
    decides where no rule does.  Input columns of these names are replaced.
    """
    added = ("host", "path", "rule", "verdict", "score")
    names = [c for c in pages.columns if c.lower() not in added]
    # Names out of reach of any input column while the parts are computed.
    aside = pages.select(
        F.struct(*(F.col(f"`{c}`") for c in names)).alias("__row"), F.col("url").alias("__url")
    )
    host, path = host_and_path(F.col("__url"))
    parted = aside.select("__row", host.alias("__host"), path.alias("__path"))
    scored = model.score(parted)
    fit = longest_rule(F.col("__host"), F.col("__path"), rules)
    verdict = F.when(F.col("score") >= THRESHOLD, "block").otherwise("allow")
    return scored.select(
        "__row.*",
        F.col("__host").alias("host"),
        F.col("__path").alias("path"),
        fit["rule"].alias("rule"),
        F.coalesce(fit["verdict"], verdict).alias("verdict"),
        "score",
    )
