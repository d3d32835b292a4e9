"""URL verdicts: host and path rules, then a linear model, in DataFrame operations only.

The model is a logistic regression on hashed character n-grams of host and
path, which have buckets of their own. Its small labelled table is literal
(``BLOCKED``, ``ALLOWED``; another can be given), hashed by the same expressions as
the pages, collected (at most ``MOST_LABELLED`` rows), and fitted on the driver; a
page's score is a sum over one constant array of ``BUCKETS`` weights, so judging
needs no shuffle and no join.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

BUCKETS, SIZES, MOST_LABELLED, STEPS, RATE, DECAY = 4096, (2, 3, 4), 10_000, 1000, 2.0, 1e-4

#: The rules of the query as (host, path, verdict).
RULES = (
    ("com", "/en/", "block"),
    ("example.com", "/en/7", "allow"),
    ("net", "/de/", "allow"),
    ("example.net", "/de/8", "block"),
    ("org", "/es/", "block"),
)

#: The labelled table: made-up addresses of unwanted kinds (gambling, drugs, adult matter, advertising and tracking, link farms, fake downloads, scams).
BLOCKED = """
http://www.royal-casino-online.top/bonus/slots
https://luckyslots777.example.com/en/630
http://bestpoker-rooms.info/texas-holdem/deposit-bonus
https://sportbetting24.example.org/odds/live-bet?aff=3391
http://casinobonus.win/no-deposit/free-spins
https://m.megajackpot-casino.example.net/fr/3082/
http://bet-365-tips.xyz/betting/football-odds
https://blog.online-gambling-guide.example.com/baccarat/cash
http://vegas-slot-machines.site/spin/win-big
https://crypto-casino.example.org/en/5534?utm_source=feed
http://poker-bonus-codes.ru/bonus/200-percent
https://winbetting.example.net/odds/horse
http://pokies-australia.top/real-money/pokies
https://m.lottery-winner.example.com/fr/7986
http://www.bingo-cash.biz/signup/bonus
http://blog.cheapviagra-online.example.org/buy/viagra-100mg
https://canadian-pharmacy.top/order/cialis-no-prescription
http://discountpills.example.net/en/1438/
https://weight-loss-pills.info/keto/burn-fat-fast
http://rxmeds-online.example.com/tramadol/overnight
https://pharmacy-no-rx.com/buy/modafinil
http://m.buy-cheap-cialis.example.org/fr/3890?utm_source=feed
https://diet-pill-miracle.site/order-now
http://blog.steroids-shop.example.net/anabolic/buy
https://onlinedrugstore.biz/pills/valium
http://hot-xxx-videos.example.com/en/6342
https://www.freepornhub-clips.net/sex/amateur
http://adultdating-local.example.org/hookup/tonight
https://sexycams.live/webcam/girls
http://m.nude-celebs.example.net/fr/8794/
https://escort-girls.top/city/escorts
http://blog.xxxtube.example.com/video/milf
https://adult-content.site/erotic/18plus
http://sex-chat-free.example.org/en/2246?utm_source=feed
https://hentai-porn.club/watch/uncensored
http://ads.popunder-network.example.net/serve/banner.js?zone=88
https://adserver.clickmedia.biz/track/impression?id=2
http://m.tracker.adclicks.example.com/fr/4698
https://click.affiliate-traffic.top/redirect?offer=991
http://blog.banner-ads.exchange-traffic.example.org/adserv/view
https://pixel.trackstat.site/collect/beacon.gif
http://popads-server.example.net/en/7150/
https://adv.doublebanner.club/click/tracking
http://telemetry.adtracker.example.com/track/user
https://syndication.adnetwork.top/ads/show
http://m.seo-backlinks-cheap.example.org/fr/602?utm_source=feed
https://linkfarm-directory.top/submit/links/page9
http://blog.buyfollowers.example.net/instagram/cheap-likes
https://article-spinner.info/seo/spam-content
http://free-traffic-bot.example.com/en/3054
https://guestpost-links.site/dofollow/backlink
http://cheap-essays.example.org/order/write-my-essay
https://doorway-pages.top/keyword/best-cheap-loans
http://m.payday-loans-fast.example.net/fr/5506/
https://instant-cash-loan.top/apply-now/bad-credit
http://blog.quick-loans-online.example.com/approval/guaranteed
https://forex-robot-profit.club/signup/earn-money-fast
http://bitcoin-doubler.example.org/en/7958?utm_source=feed
https://work-at-home-riches.info/earn/5000-week
http://free-iphone-giveaway.example.net/claim/prize
https://claim-your-prize.top/winner/gift-card
http://m.secure-login-paypa1.example.com/fr/1410
https://bank-account-verify.top/login/update-password
http://blog.warez-crack.example.org/download/keygen-serial
https://full-cracks.site/windows/activator-free-download
http://torrent-warez.example.net/en/3862/
https://free-mp3-download.biz/crack/serial
http://driver-update-scan.example.com/download/setup.exe
https://flash-player-update.info/install/now.exe
http://m.cheats-hacks.example.org/fr/6314?utm_source=feed
https://replica-watches.top/buy/rolex-cheap
http://blog.fake-designer-bags.example.net/cheap/outlet
https://cheap-jerseys-china.ru/nfl/wholesale
http://spam-mailer.example.com/en/8766
https://viagra-cialis-levitra.xyz/rx/discount
http://casino-royale.example.com/en/4410
https://m.online-casino.example.net/de/82
http://poker-night.example.org/fr/6203.html
https://slots-city.example.com/es/91
http://www.betting-odds.example.net/en/3018
https://pills-direct.example.org/de/712?utm_source=feed
http://cheaper-meds.example.com/fr/5518/
https://blog.diet-pill.example.net/en/640
http://viagra-shop.example.org/es/2201
https://adults-only.example.com/en/8114
http://m.xxx-cams.example.net/de/19#top
https://www.porn-clips.example.org/fr/977
http://ads-server.example.com/en/1203
https://click-tracker.example.net/de/4417?page=2&ref=x
http://popup-ads.example.org/es/350
https://spam-blast.example.com/en/7712
http://www.linkfarms.example.net/fr/2240.html
https://freebies-now.example.org/en/66
http://winner-cash.example.com/de/9011
https://jackpot-winner.example.net/es/405
http://quick-loans.example.org/fr/813
https://warez-crack.example.com/en/2790
""".split()
#: Addresses of wanted kinds: reference, news, science, schools, trades, libraries, blogs, pages without a host.
ALLOWED = """
https://en.wikipedia.org/wiki/Photosynthesis
https://de.wikipedia.org/wiki/Donau
https://fr.wikipedia.org/wiki/Cath%C3%A9drale
https://es.wikipedia.org/wiki/R%C3%ADo_Ebro
https://www.gutenberg.org/ebooks/1342
https://arxiv.org/abs/1706.03762
https://www.nature.com/articles/s41586-020-2649-2
https://docs.python.org/3/library/itertools.html
https://spark.apache.org/docs/latest/sql-ref.html
https://developer.mozilla.org/en-US/docs/Web/HTML
https://www.w3.org/TR/html52/
https://www.ietf.org/rfc/rfc3986.txt
https://stackoverflow.com/questions/11227809/why-is-processing
https://github.com/apache/spark/pull/100
https://www.nasa.gov/mission_pages/apollo
https://www.noaa.gov/weather/forecast
https://www.loc.gov/collections/maps/
https://www.bl.uk/manuscripts/letters
https://www.bbc.co.uk/news/world-europe-1234567
https://www.theguardian.com/environment/2019/rivers
https://www.lemonde.fr/sciences/article/2018/volcans_1650684.html
https://www.spiegel.de/wissenschaft/natur/gletscher-a-1219.html
https://elpais.com/cultura/2017/teatro.html
https://www.zeit.de/2016/12/geschichte-handel
https://www.nzz.ch/wirtschaft/ld.20071
https://www.mit.edu/courses/mathematics/18-06
https://www.ox.ac.uk/admissions/undergraduate
https://www.uni-heidelberg.de/de/studium/7731
https://www.sorbonne-universite.fr/en/research
https://www.unam.mx/es/cultura/4410
https://www.ethz.ch/en/studies/512
https://www.rijksmuseum.nl/en/collection/SK-C-5
https://www.prado.es/es/obra/1174
https://www.louvre.fr/fr/oeuvres/22
https://www.deutsches-museum.de/en/exhibitions/8
http://www.village-school.org/en/teachers/12
http://harbour-museum.org/en/visit/opening
https://www.riverside-library.org/catalogue/item/5531
http://oldtown-bakery.com/en/recipes/rye-bread
https://www.mountain-rescue.org/en/reports/2014
http://gardening-notes.net/en/roses/pruning
https://blog.northern-lights.net/en/2015/aurora
http://www.carpentry-workshop.com/en/joints/dovetail
https://m.city-transport.org/de/fahrplan/344
http://stamp-collectors.org/fr/timbres/1849
https://www.bird-observatory.org/en/ringing/2011
http://blog.sailing-diary.com/en/4212
https://www.choir-of-st-anne.org/en/concerts/77
http://physics-lectures.net/en/optics/lens
https://www.history-of-printing.org/de/druck/1455
http://m.recipes-from-home.com/en/soups/3310?page=2&ref=x
https://www.townhall.example.org/en/minutes/201.html
http://weather.station.example.net/de/1021#top
https://blog.kitchen.example.com/fr/302?utm_source=feed
http://chess-club.example.org/es/partidas/88/
https://news.harbour.example.com/en/6611
http://www.orchard.example.net/de/9021/
https://m.railway.example.org/fr/4410.html
https://forum.beekeepers.example.com/en/5212?page=2&ref=x
http://poets.example.net/es/1911
https://www.geology.example.org/en/218#top
http://letters.example.com/de/7001?utm_source=feed
https://blog.astronomy.example.net/en/3344/
http://m.tinhouse.example.com/fr/12.html
https://onthehill.example.org/en/900
http://thornton.example.com/en/5150
https://edgerton.example.net/de/2213
http://anderson-reed.example.org/es/644
https://www.thandor.example.com/en/1723
http://motherland.example.com/de/4471
https://hereford.example.net/fr/90
https://m.attention.example.org/en/2817.html
http://thereafter.example.com/es/31
https://notion.example.net/en/8213
http://m.nineteenth.example.org/fr/17#top
https://blog.enterprise.example.com/de/640/
http://www.earnest.example.net/en/5120
https://thinker.example.com/en/77?utm_source=feed
http://sixteenth.example.org/es/4409
https://m.leather.example.net/de/6120?page=2&ref=x
http://western.example.com/fr/3001
https://www.ninthhour.example.org/en/208
http://blog.southern.example.net/en/94.html
https://tenement.example.com/de/1177
http://meadow.example.org/fr/5820
https://lyrics.example.net/es/623
http://www.shepherd.example.com/en/7040/
https://m.foundation.example.org/en/381
http://ensemble.example.net/fr/2995
http://restoration.example.net/fr/8020/
https://www.weaving.example.com/en/71?page=2&ref=x
http://station.example.org/de/301#top
https://handwriting.example.net/en/4471.html
http://m.northern.example.com/en/20
https://www.interest.example.org/fr/66?utm_source=feed
http://entrance.example.net/es/7120
https://blog.thetis.example.com/en/1290
http://www.redstone.example.org/de/430/
https://m.oration.example.net/en/6312
http://heather.example.com/en/815#top
https://www.linen.example.net/de/3.html
http://stonehenge.example.org/en/99?page=2&ref=x
page one
about
/relative/path/10
index.html
""".splitlines()


def labelled_urls() -> list[tuple[str, int]]:
    """(url, 1 for block): the labelled table, at most a few hundred rows."""
    return [(u, 1) for u in BLOCKED] + [(u, 0) for u in ALLOWED if u] + [("", 0)]


def host_path(url: Column) -> tuple[Column, Column]:
    """The host (A-Z lower-cased) and the path; both empty without ``://``."""
    pattern = r"://([^/?#]*)([^?#]*)"
    host = F.coalesce(F.regexp_extract(url, pattern, 1), F.lit(""))
    letters = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
    return F.translate(host, letters, letters.lower()), F.coalesce(F.regexp_extract(url, pattern, 2), F.lit(""))


def _grams(kind: str, text: Column) -> Column:
    """The distinct buckets of a text's n-grams; any number counts as 0."""
    text = F.regexp_replace(text, "[0-9]+", "0")

    def hashed(n: int):
        return lambda i: F.pmod(F.xxhash64(F.lit(kind), F.substring(text, i, F.lit(n))), F.lit(BUCKETS)).cast("int")

    grams = []
    for n in SIZES:
        last = F.char_length(text) - (n - 1)
        places = F.when(last > 0, F.sequence(F.lit(1), last)).otherwise(F.array().cast("array<int>"))
        grams.append(F.transform(places, hashed(n)))
    return F.array_distinct(F.concat(*grams))


def _featured(df: DataFrame, url: str) -> DataFrame:
    host, path = host_path(F.col(url))
    df = df.withColumns({"__host": host, "__path": path})
    return df.withColumns({"__hosted": _grams("h", F.concat(F.lit("^"), F.col("__host"), F.lit("$"))), "__pathed": _grams("p", F.concat(F.col("__path"), F.lit("$")))})


def fit(spark: SparkSession, labelled: list[tuple[str, int]] | None = None) -> tuple[list[float], float]:
    """Weights and bias, by gradient descent over all labelled URLs (at most ``MOST_LABELLED``).

    A URL's n-grams of host and of path each have a vector of length one.
    """
    labelled = labelled_urls() if labelled is None else labelled
    if len(labelled) > MOST_LABELLED:
        raise ValueError(f"at most {MOST_LABELLED} labelled URLs")
    if not labelled:
        return [0.0] * BUCKETS, -1.0
    urls, labels = (F.lit(list(x)) for x in zip(*labelled))
    table = spark.range(1).select(F.inline(F.arrays_zip(urls.alias("url"), labels.alias("label"))).alias("url", "label"))
    rows = _featured(table, "url").select("__hosted", "__pathed", "label").collect()
    x = np.zeros((len(rows), BUCKETS))
    for k, r in enumerate(rows):
        for grams in r[:2]:
            if grams:
                x[k, grams] += 1 / np.sqrt(len(grams))
    y = np.array([r[2] for r in rows], float)
    w, bias = np.zeros(BUCKETS), 0.0
    for _ in range(STEPS):
        error = 1 / (1 + np.exp(-(x @ w + bias))) - y
        w -= RATE * (x.T @ error / len(y) * 10 + DECAY * w)
        bias -= RATE * error.mean()
    return [round(float(v), 6) for v in w], round(bias, 6)


def _rule(host: Column, path: Column, rules: tuple[tuple[str, str, str], ...]) -> tuple[Column, Column]:
    """The longest rule that fits and its verdict, null without one."""
    rule, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for h, p, v in sorted(rules, key=lambda r: (len(r[0] + r[1]), r)):  # the longest ends up outermost
        fits = ((host == h) | F.endswith(host, F.lit("." + h))) & F.startswith(path, F.lit(p))
        rule, verdict = F.when(fits, F.lit(h + p)).otherwise(rule), F.when(fits, F.lit(v)).otherwise(verdict)
    return rule, verdict


def judge(
    pages: DataFrame,
    url: str = "url",
    rules: tuple[tuple[str, str, str], ...] = RULES,
    labelled: list[tuple[str, int]] | None = None,
) -> DataFrame:
    """``pages`` with host, path, rule, verdict and score (the model's, 0 to 1).

    A rule fits its host and all subdomains where the path starts with the
    rule's; the longest wins, and rules decide before the model. A null URL, or
    one without ``://``, has an empty host and path and takes the model's verdict
    on them. Repeated rows are judged alike; columns of ``pages`` named like the
    new ones give way. Rules become one expression, so they should be some
    hundreds at most.
    """
    weights, bias = fit(pages.sparkSession, labelled)
    table = F.lit(weights)
    new = ["host", "path", "rule", "verdict", "score"]
    df = _featured(pages.withColumn("__url", F.col(url)).drop(*(c for c in new if c != url)), "__url")
    z = F.lit(bias)
    for grams in ("__hosted", "__pathed"):
        total = F.aggregate(F.transform(grams, lambda b: F.get(table, b)), F.lit(0.0), lambda acc, v: acc + v)
        z += total / F.sqrt(F.greatest(F.size(grams), F.lit(1)).cast("double"))
    df = df.withColumn("score", 1 / (1 + F.exp(-z)))
    rule, verdict = _rule(F.col("__host"), F.col("__path"), rules)
    model = F.when(F.col("score") >= 0.5, F.lit("block")).otherwise(F.lit("allow"))
    df = df.withColumns({"rule": rule, "verdict": F.coalesce(verdict, model), "host": F.col("__host"), "path": F.col("__path")})
    return df.drop("__host", "__path", "__hosted", "__pathed", "__url")
