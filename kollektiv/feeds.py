"""XML feeds (NeTEx, SIRI, ZIP archives) written by Spark from the driver's tables.

Round-trip inputs for the extractors: each function renders table rows as XML
fragments with JVM string expressions and groups fragments into documents.  A
document groups rows by a natural parent key *and* the input split the rows
came from, so a hot parent key never builds one unbounded document.
"""

from __future__ import annotations

import io
import zipfile
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from kollektiv.session import ship_package
from kollektiv.sources.siri import SIRI_NS

NETEX_NS = "http://www.netex.org.uk/netex"


def esc(c: Column) -> Column:
    """XML-escape a text column (a text without the character is left as it is)."""
    for a, b in (("&", "&amp;"), ("<", "&lt;"), (">", "&gt;"), ('"', "&quot;"), ("'", "&apos;")):
        c = F.replace(c, F.lit(a), F.lit(b))
    return c


def _py_esc(text: str) -> str:
    return (text.replace("&", "&amp;").replace("<", "&lt;").replace(">", "&gt;")
            .replace('"', "&quot;").replace("'", "&apos;"))


def s(c) -> Column:
    """Column or literal as escaped text (literals are escaped in Python)."""
    if not isinstance(c, Column):
        return F.lit(_py_esc(str(c)))
    return esc(c.cast("string"))


def el(tag: str, text=None, attrs: dict | None = None, children: list | None = None,
       prefix: str = "") -> Column:
    """``<tag a="..">text|children</tag>`` as a string column (attrs with null values are dropped)."""
    parts: list[Column] = [F.lit(f"<{prefix}{tag}")]
    for k, v in (attrs or {}).items():
        parts.append(F.coalesce(F.concat(F.lit(f' {k}="'), s(v), F.lit('"')), F.lit("")))
    if text is None and not children:
        parts.append(F.lit("/>"))
    else:
        parts.append(F.lit(">"))
        if text is not None:
            parts.append(F.coalesce(s(text), F.lit("")))
        for ch in children or []:
            parts.append(F.coalesce(ch, F.lit("")))
        parts.append(F.lit(f"</{prefix}{tag}>"))
    return F.concat(*parts)


def documents(rows: DataFrame, fragment: Column, keys: list[str], head, tail,
              name: str, keep_keys: bool = False) -> DataFrame:
    """Group fragments into documents ``(path, member, content)``.

    ``head`` and ``tail`` are strings or functions of the grouping-key columns.
    """
    pid = "__kollektiv_split"
    grouped = (rows.withColumn(pid, F.spark_partition_id())
               .groupBy(*keys, pid)
               .agg(F.concat_ws("", F.collect_list(fragment)).alias("__body")))
    h = head(*[F.col(k) for k in keys]) if callable(head) else F.lit(head)
    t = tail(*[F.col(k) for k in keys]) if callable(tail) else F.lit(tail)
    path = F.concat(F.lit(f"gen/{name}"), *[F.concat(F.lit("-"), F.col(k).cast("string")) for k in keys],
                    F.lit("-"), F.col(pid).cast("string"), F.lit(".xml"))
    return grouped.select(path.alias("path"), F.lit(None).cast("string").alias("member"),
                          F.concat(h, F.col("__body"), t).alias("content"), *(keys if keep_keys else []))


def nested_documents(rows: DataFrame, fragment: Column, key: str, head, tail, name: str, frame: str,
                     buckets: int = 8) -> DataFrame:
    """Documents of many elements, one for each ``key`` (and input split) around
    its fragments; ``head`` and ``tail`` are functions of the key."""
    pid = "__kollektiv_element_split"
    elements = (rows.withColumn(pid, F.spark_partition_id()).groupBy(key, pid)
                .agg(F.concat_ws("", F.collect_list(fragment)).alias("__body")))
    whole = F.concat(head(F.col(key)), F.col("__body"), tail(F.col(key)))
    elements = elements.select(F.pmod(F.xxhash64(key), F.lit(buckets)).alias("__bucket"), whole.alias("__element"))
    return documents(elements, F.col("__element"), ["__bucket"], _netex_head(frame), _netex_tail(frame), name)


def _netex_head(frame: str = "SiteFrame") -> str:
    return (f'<?xml version="1.0" encoding="UTF-8"?><PublicationDelivery xmlns="{NETEX_NS}" version="1.0">'
            f'<dataObjects><{frame} id="F1" version="1">')


def _netex_tail(frame: str = "SiteFrame") -> str:
    return f"</{frame}></dataObjects></PublicationDelivery>"


def netex_documents(rows: DataFrame, fragment: Column, keys: list[str], name: str,
                    frame: str = "SiteFrame") -> DataFrame:
    return documents(rows, fragment, keys, _netex_head(frame), _netex_tail(frame), name)


def lpad_num(c: Column, n: int) -> Column:
    return F.lpad(c.cast("string"), n, "0")


# --- NeTEx feeds -------------------------------------------------------------
def topographic_places(nation: DataFrame, region: DataFrame) -> DataFrame:
    k = F.col("n_nationkey")
    iso = F.upper(F.substring("n_name", 1, 2))
    desc = (F.when(k % 3 == 0, el("Descriptor", children=[el("Name", F.col("n_name"))]))
            .when(k % 3 == 1, el("Descriptor", F.col("n_name")))
            .otherwise(el("Descriptor")))
    nat = el("TopographicPlace", attrs={"id": F.concat(F.lit("N"), k.cast("string")), "version": "1"}, children=[
        el("IsoCode", iso), desc, el("TopographicPlaceType", "country"),
        el("CountryRef", attrs={"ref": F.lower(F.substring("n_name", 1, 2))}),
        el("PrivateCode", k),
        el("ParentTopographicPlaceRef", attrs={"ref": F.concat(F.lit("R"), F.col("n_regionkey").cast("string")),
                                               "version": "1"})])
    reg = el("TopographicPlace", attrs={"id": F.concat(F.lit("R"), F.col("r_regionkey").cast("string")),
                                        "version": "2"}, children=[
        el("Descriptor", children=[el("Name", F.col("r_name"))]), el("TopographicPlaceType", "region")])
    return (netex_documents(nation, nat, ["n_regionkey"], "nations")
            .unionByName(netex_documents(region, reg, ["r_regionkey"], "regions")))


def _lon(nat: Column, k: Column) -> Column:
    return F.concat((nat + 10).cast("string"), F.lit("."), lpad_num(k % 1000, 3))


def _lat(k: Column) -> Column:
    return F.concat(F.lit("59."), lpad_num(k % 100000, 5))


def stop_place_fragment(prefix: str = "") -> Column:
    k, nat = F.col("s_suppkey"), F.col("s_nationkey")
    lon, lat = _lon(nat, k), _lat(k)
    cen = (F.when(k % 3 == 0, el("Centroid", prefix=prefix, children=[el("Location", prefix=prefix, children=[
                el("Longitude", lon, prefix=prefix), el("Latitude", lat, prefix=prefix)])]))
           .when(k % 3 == 1, el("Centroid", prefix=prefix, children=[el("Location", prefix=prefix, children=[
                el("Long", lon, prefix=prefix), el("Lat", lat, prefix=prefix)])])))
    child = F.when(k % 10 == 0, el("StopPlace", prefix=prefix, attrs={
        "id": F.concat(F.lit("S"), k.cast("string"), F.lit("-child")), "version": "1"},
        children=[el("Name", F.concat(F.col("s_name"), F.lit(" child")), prefix=prefix)]))
    return el("StopPlace", prefix=prefix, attrs={"id": F.concat(F.lit("S"), k.cast("string")),
                                                 "version": (k % 4 + 1).cast("string")}, children=[
        el("Name", F.col("s_name"), prefix=prefix),
        F.when(k % 2 == 0, el("ShortName", F.concat(F.lit("S"), k.cast("string")), prefix=prefix)),
        el("PrivateCode", k, prefix=prefix),
        cen,
        el("TopographicPlaceRef", prefix=prefix, attrs={"ref": F.concat(F.lit("N"), nat.cast("string")),
                                                        "version": "1"}),
        F.when(k % 7 != 0, el("OrganisationRef", prefix=prefix,
                              attrs={"ref": F.concat(F.lit("ORG"), (k % 7).cast("string"))})),
        F.when(k % 5 == 0, el("ParentSiteRef", prefix=prefix,
                              attrs={"ref": F.concat(F.lit("P"), nat.cast("string")), "version": "3"})),
        el("TransportMode", "bus", prefix=prefix),
        el("StopPlaceType", "onstreetBus", prefix=prefix),
        child])


def stop_places(supplier: DataFrame) -> DataFrame:
    return netex_documents(supplier, stop_place_fragment(), ["s_nationkey"], "stops")


def quays(lineitem: DataFrame) -> DataFrame:
    pairs = lineitem.select("l_suppkey", "l_partkey").distinct()
    sk, pk = F.col("l_suppkey"), F.col("l_partkey")
    quay_tag = F.when(pk % 2 == 0, F.lit("Quay")).otherwise(F.lit("BoardingPosition"))
    frag = F.concat(F.lit("<"), quay_tag, F.lit(' id="Q'), sk.cast("string"), F.lit("-"), pk.cast("string"),
                    F.lit('" version="'), (pk % 3 + 1).cast("string"), F.lit('"><Name>Quay '),
                    pk.cast("string"), F.lit("</Name></"), quay_tag, F.lit(">"))
    def wrapper(supp):
        return F.when(supp % 2 == 0, F.lit("quays")).otherwise(F.lit("Quays"))

    def head(supp):
        return F.concat(F.lit('<StopPlace id="S'), supp.cast("string"),
                        F.lit('" version="1"><Name>Stop '), supp.cast("string"), F.lit("</Name><"),
                        wrapper(supp), F.lit(">"))

    def tail(supp):
        return F.concat(F.lit("</"), wrapper(supp), F.lit("></StopPlace>"))
    return nested_documents(pairs, frag, "l_suppkey", head, tail, "quays", "SiteFrame")


def scheduled_stop_points(part: DataFrame) -> DataFrame:
    k = F.col("p_partkey")
    lon = F.concat(F.lit("15."), lpad_num(k % 1000, 3))
    lat = F.concat(F.lit("59."), lpad_num(k % 10000, 4))
    both = el("Location", children=[el("Longitude", lon), el("Latitude", lat)])
    coords = (F.when(k % 5 == 0, el("Centroid", children=[both]))
              .when(k % 5 == 1, el("Location", children=[el("Latitude", lat)]))
              .when(k % 5 == 2, F.concat(both, el("Centroid")))
              .when(k % 5 == 3, F.concat(el("Centroid", children=[el("Location", children=[el("Long", lon)])]),
                                         el("Location", children=[el("Latitude", lat)]))))
    tag = (F.when(k % 4 == 0, F.lit("ScheduledStopPoint")).when(k % 4 == 1, F.lit("StopPoint"))
           .when(k % 4 == 2, F.lit("StopArea")).otherwise(F.lit("StopPointInFrame")))
    code = F.when(k % 2 == 0, el("PublicCode", F.col("p_brand"))).otherwise(el("publicCode", F.col("p_brand")))
    body = F.concat(
        el("Name", F.col("p_name")), code,
        el("StopPlaceRef", attrs={"ref": F.concat(F.lit("S"), (k % 100).cast("string")), "version": "1"}),
        F.coalesce(coords, F.lit("")))
    frag = F.concat(F.lit("<"), tag, F.lit(' id="SSP'), k.cast("string"), F.lit('" version="'),
                    F.col("p_size").cast("string"), F.lit('">'), body, F.lit("</"), tag, F.lit(">"))
    return netex_documents(part, frag, ["p_type"], "stoppoints", "ServiceFrame")


def lines(part: DataFrame) -> DataFrame:
    k = F.col("p_partkey")
    lid = F.concat(F.lit("L"), k.cast("string"))
    code = el("PublicCode", F.col("p_size"))
    frag = (F.when(k % 3 == 0, el("Line", attrs={"id": lid, "version": F.col("p_size")},
                                  children=[el("Name", F.col("p_name")), code]))
            .when(k % 3 == 1, el("Line", attrs={"id": lid, "version": F.col("p_size")}, children=[
                el("Presentation", children=[el("Name", F.col("p_name"))]), el("Name", "other"), code]))
            .otherwise(el("Line", attrs={"id": lid}, children=[code])))
    return netex_documents(part, frag, ["p_size"], "lines", "ServiceFrame")


def journey_patterns(orders: DataFrame) -> DataFrame:
    o = F.col("o_orderkey")
    ref = el("RouteRef", attrs={"ref": F.concat(F.lit("R"), F.col("o_custkey").cast("string"))})
    frag = el("JourneyPattern", attrs={"id": F.concat(F.lit("JP"), o.cast("string")),
                                       "version": F.col("o_orderstatus")}, children=[
        F.when(o % 4 == 1, el("routeView", children=[ref])).when(o % 4 != 0, ref),
        el("Name", F.col("o_orderpriority"))])
    return netex_documents(orders, frag, ["o_orderpriority"], "patterns", "ServiceFrame")


def journey_pattern_stops(lineitem: DataFrame) -> DataFrame:
    o, ln, pk, sk = F.col("l_orderkey"), F.col("l_linenumber"), F.col("l_partkey"), F.col("l_suppkey")
    ssp = F.concat(F.lit("SSP"), pk.cast("string"))
    none = pk % 10 == 0
    order = (F.when(sk % 4 == 0, ln.cast("string")).when(sk % 4 == 1, F.concat(ln.cast("string"), F.lit(".5")))
             .when(sk % 4 == 2, F.lit("x")))
    sid = F.concat(F.lit("SPJP-"), o.cast("string"), F.lit("-"), ln.cast("string"), F.lit("-"), pk.cast("string"))
    board = el("ForBoarding", F.when(F.col("l_returnflag") == "R", F.lit("false")).otherwise(F.lit("true")))
    alight = F.when(F.col("l_linestatus") == "O", el("ForAlighting", "true"))
    frag = el("StopPointInJourneyPattern", attrs={
        "id": sid, "order": order, "ref": F.when(~none & (ln % 3 == 1), ssp)}, children=[
        F.when(~none & (ln % 3 == 0), el("ScheduledStopPointRef", attrs={"ref": ssp})),
        F.when(~none & (ln % 3 == 2), el("StopPointRef", attrs={"ref": ssp})),
        board, alight])

    def head(order_key):
        return F.concat(F.lit('<JourneyPattern id="JP'), order_key.cast("string"), F.lit('" version="1"><RouteRef ref="R'),
                        order_key.cast("string"), F.lit('"/><pointsInSequence>'))
    return nested_documents(lineitem, frag, "l_orderkey", head,
                            lambda _: F.lit("</pointsInSequence></JourneyPattern>"), "jpstops", "ServiceFrame")


def namespaced_stop_places(supplier: DataFrame) -> DataFrame:
    """One document per supplier: default namespace, ``netex:`` prefix, or none (key % 3)."""
    k = F.col("s_suppkey")
    variants = {
        0: (f'<PublicationDelivery xmlns="{NETEX_NS}">', "</PublicationDelivery>", ""),
        1: (f'<netex:PublicationDelivery xmlns:netex="{NETEX_NS}">', "</netex:PublicationDelivery>", "netex:"),
        2: ("<PublicationDelivery>", "</PublicationDelivery>", ""),
    }
    content = None
    for i, (h, t, p) in variants.items():
        doc = F.concat(F.lit(h), stop_place_fragment(p), F.lit(t))
        content = F.when(k % 3 == i, doc) if content is None else content.when(k % 3 == i, doc)
    return supplier.select(F.concat(F.lit("gen/ns-"), k.cast("string"), F.lit(".xml")).alias("path"),
                           F.lit(None).cast("string").alias("member"), content.alias("content"))


def damaged_stop_places(supplier: DataFrame) -> DataFrame:
    """One document per supplier; every seventh is cut short (malformed)."""
    k = F.col("s_suppkey")
    doc = F.concat(F.lit(_netex_head()), stop_place_fragment(), F.lit(_netex_tail()))
    cut = F.substring(doc, 1, (F.length(doc) / 2).cast("int"))
    return supplier.select(F.concat(F.lit("gen/dmg-"), k.cast("string"), F.lit(".xml")).alias("path"),
                           F.lit(None).cast("string").alias("member"),
                           F.when(k % 7 == 0, cut).otherwise(doc).alias("content"))


# --- archives ------------------------------------------------------------------
def _zip_batches(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for pdf in batches:
        out = []
        for i, (path, content) in enumerate(zip(pdf["path"], pdf["content"])):
            stem = path.rsplit("/", 1)[-1].rsplit(".", 1)[0]
            buf = io.BytesIO()
            with zipfile.ZipFile(buf, "w", zipfile.ZIP_DEFLATED) as z:
                ext = ".XML" if len(stem) % 2 else ".xml"
                z.writestr(f"netex/{stem}{ext}", content.encode("utf-8") if isinstance(content, str) else content)
                z.writestr("readme.txt", "not xml; ignored")
                z.writestr(f"netex/{stem}-broken.xml", "<PublicationDelivery><Line id='x'>")
                z.writestr(f"netex/{stem}-notes.xml.bak", "<ignored/>")
            out.append((f"{stem}.zip", buf.getvalue()))
        yield pd.DataFrame(out, columns=["name", "content"])


def zip_archives(docs: DataFrame) -> DataFrame:
    """One ZIP per document: the document (``.xml`` or ``.XML``), a text file,
    a malformed XML member and a ``.xml.bak`` member -> ``(name, content)``."""
    ship_package(docs.sparkSession)
    return docs.select("path", "content").mapInPandas(_zip_batches, "name string, content binary")


# --- SIRI feed -----------------------------------------------------------------
def ts_text(ts: Column, key: Column) -> Column:
    """ISO-8601 texts in four shapes by ``key % 4``: ``Z``; ``+01:00``; no
    offset; ``-05:30`` with milliseconds only."""
    iso = "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"
    return (F.when(key % 4 == 0, F.concat(F.date_format(ts, iso), F.lit("Z")))
            .when(key % 4 == 1, F.concat(F.date_format(F.timestamp_add("HOUR", F.lit(1), ts), iso),
                                         F.lit("+01:00")))
            .when(key % 4 == 2, F.date_format(ts, iso))
            .otherwise(F.concat(F.date_format(F.timestamp_add("MINUTE", F.lit(-330), ts),
                                              "yyyy-MM-dd'T'HH:mm:ss.SSS"), F.lit("-05:30"))))


def siri_timetable(events: DataFrame, keys: tuple[str, ...] = (), buckets: int = 16) -> DataFrame:
    """SIRI documents from events: calls grouped into journeys (user, day),
    journeys grouped into documents (``keys`` + the split they sit in + one of
    ``buckets`` hash buckets of the journey)."""
    eid, ts = F.col("event_id"), F.col("ts")
    delay = eid % 600
    arrived = F.col("event_type") != "error"
    call = el("RecordedCall", children=[
        el("StopPointRef", F.col("event_type")),
        el("AimedArrivalTime", ts_text(ts, eid)),
        F.when(arrived, el("ActualArrivalTime", ts_text(F.timestamp_add("SECOND", delay, ts), eid))),
        el("AimedDepartureTime", ts_text(F.timestamp_add("SECOND", F.lit(30), ts), eid)),
        F.when(arrived, el("ActualDepartureTime", ts_text(F.timestamp_add("SECOND", delay + 30, ts), eid)))])
    pid = "__kollektiv_split"
    journeys = (events.withColumn("__day", F.to_date("ts")).withColumn(pid, F.spark_partition_id())
                .groupBy(*keys, "user_id", "__day", pid)
                .agg(F.concat_ws("", F.collect_list(call)).alias("__calls")))
    u, day = F.col("user_id"), F.col("__day")
    day_text = (F.when(u % 11 == 0, F.lit("not-a-date"))
                .when(u % 3 == 1, F.concat(F.date_format(day, "yyyy-MM-dd"), F.lit("T00:00:00")))
                .otherwise(F.date_format(day, "yyyy-MM-dd")))
    line = F.concat(F.lit("line-"), (u % 12).cast("string"))
    route = F.concat(F.lit("route-"), (u % 12).cast("string"), F.lit("-"), (u % 2).cast("string"))
    journey = F.concat(
        F.lit("<EstimatedVehicleJourney>"),
        F.when(u % 2 == 0, el("LineRef", line)).otherwise(el("LineRef", attrs={"ref": line})),
        el("DirectionRef", (u % 2 + 1).cast("string")),
        el("FramedVehicleJourneyRef", children=[el("DataFrameRef", day_text), el("DatedVehicleJourneyRef", u)]),
        F.coalesce(F.when(u % 3 == 0, el("RouteRef", route)).when(u % 3 == 1, el("RouteRef", attrs={"ref": route})),
                   F.lit("")),
        el("VehicleMode", F.when(u % 5 == 0, F.lit("tram")).otherwise(F.lit("bus"))),
        el("ArrivalStatus", F.when(u % 3 == 0, F.lit("onTime")).otherwise(F.lit("delayed"))),
        F.coalesce(F.when(u % 4 != 0, el("DepartureStatus", "onTime")), F.lit("")),
        el("Cancellation", "false"),
        el("DepartureBoardingActivity", "boarding"),
        F.lit("<RecordedCalls><!-- recorded calls -->"), F.col("__calls"),
        F.lit("</RecordedCalls><EstimatedCalls><EstimatedCall><StopPointRef>future</StopPointRef>"
              "<AimedArrivalTime>2030-01-01T00:00:00Z</AimedArrivalTime></EstimatedCall></EstimatedCalls>"
              "</EstimatedVehicleJourney>"))
    head = (f'<?xml version="1.0" encoding="UTF-8"?><Siri xmlns="{SIRI_NS}" version="2.0"><ServiceDelivery>'
            "<EstimatedTimetableDelivery><EstimatedJourneyVersionFrame>"
            "<EstimatedVehicleJourney><LineRef>empty-journey</LineRef></EstimatedVehicleJourney>")
    tail = "</EstimatedJourneyVersionFrame></EstimatedTimetableDelivery></ServiceDelivery></Siri>"
    # documents of a few hundred journeys: keys + split + a hash bucket of the journey
    bucket = F.pmod(F.xxhash64("user_id", "__day"), F.lit(buckets))
    docs = documents(journeys.select(*keys, bucket.alias("__bucket"), journey.alias("__journey")),
                     F.col("__journey"), list(keys) + ["__bucket"], head, tail, "siri", keep_keys=True)
    return docs.drop("__bucket")


def siri_heartbeats(events: DataFrame) -> DataFrame:
    """Snapshots without recorded calls: one journey per day and split, no
    ``RecordedCalls`` (the feed answered, but nothing has happened yet)."""
    rows = events.withColumn("__day", F.to_date("ts"))
    frag = F.concat(F.lit("<EstimatedVehicleJourney><LineRef>"), F.col("user_id").cast("string"),
                    F.lit("</LineRef></EstimatedVehicleJourney>"))
    head = (f'<Siri xmlns="{SIRI_NS}"><ServiceDelivery><EstimatedTimetableDelivery>'
            "<EstimatedJourneyVersionFrame>")
    tail = "</EstimatedJourneyVersionFrame></EstimatedTimetableDelivery></ServiceDelivery></Siri>"
    return documents(rows, frag, ["__day"], head, tail, "heartbeat")


def siri_snapshots(events: DataFrame) -> DataFrame:
    """Snapshot files for the live stream, ``(name, content)`` under
    ``snapshot=<label>/``.  Every day: a noon snapshot of the morning's calls;
    an end-of-day snapshot of all calls, except on Sundays (feed outage); on
    Mondays a later snapshot holding only calls that never arrived (a broken
    feed: it fails the null-rate gate and must not replace the day)."""
    e = events.withColumn("__d", F.to_date("ts"))
    dow = F.dayofweek("__d")          # 1 = Sunday, 2 = Monday
    label = lambda suffix: F.concat(F.date_format("__d", "yyyy-MM-dd"), F.lit(suffix))
    noon = e.filter(F.hour("ts") < 12).withColumn("__snap", label("T120000"))
    full = e.filter(dow != 1).withColumn("__snap", label("T235900"))
    bad = e.filter((dow == 2) & (F.col("event_type") == "error")).withColumn("__snap", label("T235930"))
    docs = siri_timetable(noon.unionByName(full).unionByName(bad), keys=("__snap",), buckets=1)
    name = F.concat(F.lit("snapshot="), F.col("__snap"), F.lit("/"),
                    F.element_at(F.split("path", "/"), -1))
    return docs.select(name.alias("name"), F.encode("content", "UTF-8").alias("content"))
