"""A small labelled url table: what a reviewer blocked (1) and let pass (0)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

BLOCKED = """
http://casino-win.example.net/en/10
https://www.casino-royal.example.com/slots/2
http://online-casino.example.org/bonus.html
https://blog.casino-win.example.net/de/2011/
https://free-bets.example.net/en/1
http://www.free-bets.example.com/fr/77.html
https://sports-bets.example.org/odds?x=1
http://bet-now.example.net/en/5#top
https://poker-jackpot.example.com/play/
http://jackpot-slots.example.net/es/9
https://cheap-pills.example.net/en/4
http://blog.cheap-pills.example.net/es/12?utm_source=feed
https://buy-pills.example.com/viagra/cheap.html
http://pharmacy-discount.example.org/pills/3
https://cheap-meds.example.com/de/31/
http://viagra-cialis.example.net/order
https://m.ads-track.example.com/en/6
http://ads-track.example.com/click?id=3
https://ad-server.example.net/banner/1.html
http://track-clicks.example.org/redirect/8
https://adserver.example.com/popup
http://popads.example.net/en/2
https://adult-x.example.com/en/3
http://www.adult-x.example.com/es/15?utm_source=feed
https://xxx-videos.example.net/porn/7
http://sex-cams.example.org/live/
https://porn-hub.example.net/fr/19.html
http://adult-dating.example.com/en/22
https://www.spam-farm.example.org/en/8
http://spam-farm.example.org/es/40/
https://link-farm.example.net/seo/backlinks
http://spam-links.example.com/de/21
https://buy-followers.example.net/cheap/
http://free-money.example.com/win/prize
https://win-prize.example.org/claim/now
http://free-iphone.example.net/winner.html
https://crack-warez.example.com/keygen/5
http://warez-download.example.net/torrent/3
https://payday-loans.example.com/apply/
http://quick-loans.example.org/en/cash
https://replica-watches.example.net/cheap/2
http://miracle-diet.example.com/lose-weight/
https://phishing-login.example.net/verify/account
http://secure-verify.example.org/paypal/login.html
https://malware-kit.example.com/exe/1
http://crypto-doubler.example.net/invest/
https://get-rich.example.com/fast/cash
http://mlm-income.example.org/join/now
http://casinobonus.example.com/en/3
https://freebets.example.org/es/2/
http://pillshop.example.net/en/14.html
https://www.pornclips.example.com/fr/8
http://spamlinks.example.net/de/5
https://m.adstracker.example.com/en/12#top
http://betting.example.net/en/9?page=2
https://blog.slotswin.example.org/de/30/
"""

PASSED = """
http://thering.example.org/de/39547.html
https://blog.tionble.example.com/en/7198#top
https://tionsh.example.net/es/26123?page=2&ref=x
http://www.thering.example.net/en/10.html
https://therha.example.net/en/35332/
https://m.ththan.example.com/en/2
http://ththnd.example.net/fr/17
https://www.ththes.example.org/es/4/
http://m.tiontion.example.com/de/88?utm_source=feed
https://blog.ththth.example.net/en/5#top
http://anding.example.com/fr/200.html
https://ererst.example.net/de/31
http://www.onthing.example.net/en/62/
https://m.hentio.example.net/es/7.html
http://blog.leaing.example.com/en/19?page=2
https://news.example.com/world/2021/article.html
http://www.newspaper.example.net/politics/55
https://university.example.org/research/papers/3
http://library.example.net/catalog/books/12
https://encyclopedia.example.com/wiki/history
http://museum.example.org/en/collection/9
https://weather.example.net/forecast/en
http://cooking.example.com/recipes/bread.html
https://gardening.example.net/fr/plants/2
http://travel-guide.example.com/es/cities/4
https://science-daily.example.org/en/biology/8
http://blog.writer.example.net/de/essays/1
https://docs.software.example.com/manual/install.html
http://forum.linux.example.org/thread/77
https://school.example.net/lessons/math/6
http://health.example.org/en/nutrition/3
https://city-council.example.com/meetings/2020
http://www.railway.example.net/timetable/de
https://sports.example.com/football/report/5
http://music-review.example.net/en/albums/21
https://photography.example.org/gallery/14
http://history-notes.example.com/en/rome/2
https://m.economy.example.net/fr/markets/9
http://books.example.com/review/88.html
https://astronomy.example.net/en/planets/
http://language.example.org/es/grammar/7
https://www.architecture.example.com/de/houses/30
http://film.example.net/en/critics/11?page=2
https://chess.example.com/openings/4
http://birds.example.org/en/species/67
https://theatre.example.net/fr/plays/3
http://blog.maths.example.com/en/proofs/12#top
https://cycling.example.net/es/routes/25/
http://local-history.example.org/de/villages/8
https://www.radio.example.com/en/programmes/5
http://trains.example.net/en/1/
https://adventure.example.com/en/13
http://address-book.example.net/de/6
https://better-sleep.example.org/en/41
http://winter.example.net/fr/3
https://windows.example.com/en/help/2
http://alphabet.example.net/es/18
https://m.freedom.example.com/en/press/7
http://essex-county.example.org/en/parish/4
https://farmers.example.net/de/market/10
https://green-meadow.example.net/en/11
http://old-town.example.com/en/27.html
https://north-shore.example.org/fr/9/
http://www.silver-lake.example.net/en/5#top
https://blog.paper-boat.example.com/de/18?page=2
http://m.stone-bridge.example.net/es/33
https://little-theatre.example.com/en/6?utm_source=feed
http://high-school.example.org/en/71/
https://long-walk.example.net/en/40
http://www.apple-orchard.example.com/fr/13.html
https://red-kite.example.org/de/22
http://open-library.example.net/en/19
https://blog.tea-house.example.net/en/8
http://winter-sports.example.com/de/17/
https://early-music.example.net/es/26
http://blog.anderson.example.com/en/101
https://www.northern.example.com/fr/138.html
http://m.thornton.example.com/de/175/
https://blog.reston.example.net/es/212?page=2&ref=x
http://www.brother.example.net/en/249#top
https://m.leather.example.net/fr/286?utm_source=feed
http://blog.theorist.example.org/de/323
https://www.another.example.org/es/360.html
http://m.weather.example.org/en/397/
https://blog.southern.example.com/fr/434?page=2&ref=x
http://www.whether.example.com/de/471#top
https://m.tornado.example.com/es/508?utm_source=feed
http://blog.hinterland.example.net/en/545
https://www.thunder.example.net/fr/582.html
http://m.interest.example.net/de/619/
https://blog.orchard.example.org/es/656?page=2&ref=x
http://www.lantern.example.org/en/693#top
https://m.entire.example.org/fr/730?utm_source=feed
http://blog.earth.example.com/de/767
https://www.rather.example.com/es/804.html
http://m.shelter.example.com/en/841/
https://blog.tenor.example.net/fr/878?page=2&ref=x
http://www.thread.example.net/de/915#top
https://m.these.example.net/es/952?utm_source=feed
http://blog.either.example.org/en/989
https://www.those.example.org/fr/1026.html
http://m.northstar.example.org/de/1063/
https://blog.threshold.example.com/es/1100?page=2&ref=x
http://www.theodor.example.com/en/1137#top
"""


def labelled_urls(spark: SparkSession) -> DataFrame:
    rows = [(u, 1) for u in BLOCKED.split()] + [(u, 0) for u in PASSED.split()]
    return spark.createDataFrame(rows, "url string, blocked int")
