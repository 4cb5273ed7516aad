"""The event readers equal brute-force walks over whole trees on random documents."""

import xml.etree.ElementTree as ET

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from kollektiv.schemas import netex_fields
from kollektiv.sources import events, netex, siri

NAMES = ["StopPlace", "Quay", "quays", "Name", "Centroid", "Location", "Longitude", "Latitude", "Line",
         "PublicCode", "JourneyPattern", "StopPointInJourneyPattern", "ScheduledStopPointRef", "RouteRef",
         "StopPoint", "StopArea", "TopographicPlace", "Descriptor", "Frame"]


@st.composite
def trees(draw, depth=0):
    tag = draw(st.sampled_from(NAMES))
    attrs = draw(st.dictionaries(st.sampled_from(["id", "version", "ref", "order"]),
                                 st.sampled_from(["1", "2", "x", "", "A"]), max_size=3))
    text = draw(st.one_of(st.none(), st.sampled_from(["t", "1.5", ""])))
    kids = draw(st.lists(trees(depth=depth + 1), max_size=0 if depth >= 4 else 4))
    attr_text = "".join(f' {k}="{v}"' for k, v in attrs.items())
    return f"<{tag}{attr_text}>{text or ''}{''.join(kids)}</{tag}>"


def tree_walk(content: bytes, quay_details: bool = False):
    """Brute force: the rules of SRC-3..9 asked of a whole tree, in document order."""
    name = lambda e: e.tag.rpartition("}")[2]
    below = lambda e, *n: [d for d in e.iter() if d is not e and name(d) in n]
    first = lambda e, n: next(iter(below(e, n)), None)
    text_of = lambda e: None if e is None else e.text
    ref_of = lambda e: None if e is None else e.get("ref")

    def last(e, *n):
        found = below(e, *n)
        return found[-1].text if found else None
    axes = {"Centroid_Long": ("Longitude", "Long"), "Centroid_Lat": ("Latitude", "Lat")}
    out = []
    for el in ET.fromstring(content).iter():
        kind, me = name(el), {"id": el.get("id"), "version": el.get("version")}
        quays, stops = [], []
        if kind == "TopographicPlace":
            for c in el:
                n = name(c)
                if n in ("IsoCode", "TopographicPlaceType", "PrivateCode"):
                    me[n] = c.text
                if n in ("CountryRef", "ParentTopographicPlaceRef"):
                    me[n] = c.get("ref")
                    if n != "CountryRef":
                        me["ParentTopographicPlaceVersion"] = c.get("version")
                if n == "Descriptor" and ((len(c) and c[0].text) or c.text):
                    me[n] = (len(c) and c[0].text) or c.text
            out.append(("topographic_place", me))
        elif kind == "StopPlace":
            for c in el:
                n = name(c)
                if n in ("Name", "ShortName", "PrivateCode", "TransportMode", "StopPlaceType"):
                    me[n] = c.text
                if n == "Centroid":
                    me.update({f: last(c, *ns) for f, ns in axes.items() if last(c, *ns) is not None})
                for r, v in (("TopographicPlaceRef", "TopographicPlaceVersion"), ("OrganisationRef", None), ("ParentSiteRef", "ParentSiteVersion")):
                    if n == r:
                        me.update({r: c.get("ref"), **({v: c.get("version")} if v else {})})
                for q in c if n.lower() == "quays" else ():
                    quay = {"id": q.get("id"), "version": q.get("version"), "stopPlaceId": el.get("id")}
                    if quay_details:
                        quay["Name"] = text_of(next((x for x in q if name(x) == "Name"), None))
                        point = next((x for x in q if name(x) == "Centroid"), None)
                        if point is not None:
                            quay.update({f: last(point, *ns) for f, ns in axes.items()})
                    quays.append(("quay", quay))
            out += [("stop_place", me), *quays]
        elif kind in netex.STOP_POINT_TAGS:
            for c in el:
                n = name(c)
                if n == "Name":
                    me["Name"] = c.text
                if n in ("PublicCode", "publicCode"):
                    me["PublicCode"] = c.text
                if n == "StopPlaceRef":
                    me.update({"StopPlaceRef": c.get("ref"), "StopPlaceRefVersion": c.get("version")})
                if n == "Centroid":
                    me.update({f: last(c, *ns) for f, ns in axes.items()})
                if n == "Location":
                    me.update({f: first(c, ns[0]).text for f, ns in axes.items() if first(c, ns[0]) is not None})
            out.append(("scheduled_stop_point", me))
        elif kind == "Line":
            out.append(("line", me | {n: text_of(first(el, n)) for n in ("Name", "PublicCode")}))
        elif kind == "JourneyPattern":
            for s in below(el, "StopPointInJourneyPattern"):
                ref = ref_of(first(s, "ScheduledStopPointRef"))
                stops.append(("journey_pattern_stop", {
                    "journeyPatternId": el.get("id"), "stopOrder": s.get("order") or None, "stopPointInJourneyPatternId": s.get("id"),
                    "scheduledStopPointRef": (s.get("ref") or ref_of(first(s, "StopPointRef"))) if ref is None else ref,
                    "forBoarding": text_of(first(s, "ForBoarding")), "forAlighting": text_of(first(s, "ForAlighting"))}))
            out += [("journey_pattern", me | {"RouteRef": ref_of(first(el, "RouteRef"))}), *stops]
    return out


def filled(records):
    return [(k, tuple(f.get(c) for c in netex_fields(k, True))) for k, f in records]


@settings(max_examples=250, deadline=None, suppress_health_check=list(HealthCheck))
@given(body=st.lists(trees(), min_size=1, max_size=4), details=st.booleans(), chunk=st.sampled_from([1, 7, 1 << 16]))
def test_event_reader_equals_tree_walk(body, details, chunk, monkeypatch):
    doc = f'<PublicationDelivery xmlns="http://www.netex.org.uk/netex">{"".join(body)}</PublicationDelivery>'
    monkeypatch.setattr(events, "CHUNK", chunk)
    assert filled(netex.walk_document(doc, details)) == filled(tree_walk(doc.encode(), details))


def test_memory_does_not_grow_with_the_document():
    """A document of any number of records is read in the space of a few."""
    import tracemalloc

    class Feed:
        def __init__(self, n):
            self.parts = iter([b"<R>", *[b"<StopPlace id='%d'><Name>n</Name><quays><Quay id='q'/></quays></StopPlace><x>t</x>" % i
                                         for i in range(n)], b"</R>"])

        def read(self, _):
            return next(self.parts, b"")
    peaks = []
    for n in (2_000, 40_000):
        tracemalloc.start()
        events.check(Feed(n))
        assert sum(1 for _ in netex.read_document(Feed(n))) == 2 * n
        peaks.append(tracemalloc.get_traced_memory()[1])
        tracemalloc.stop()
    # the second document's list of parts is the test's own
    assert peaks[1] < 25 * peaks[0]


SIRI_CHILDREN = ["LineRef", "RouteRef", "DirectionRef", "VehicleMode", "ArrivalStatus", "FramedVehicleJourneyRef",
                 "RecordedCalls", "EstimatedCalls", "Other"]
CALL_CHILDREN = ["StopPointRef", "AimedArrivalTime", "ActualArrivalTime", "AimedDepartureTime", "X"]


@st.composite
def siri_journeys(draw, depth=0):
    parts = []
    for tag in draw(st.lists(st.sampled_from(SIRI_CHILDREN), max_size=6)):
        if tag == "FramedVehicleJourneyRef":
            parts.append("<FramedVehicleJourneyRef><DataFrameRef>2025-10-27</DataFrameRef>"
                         f"<DatedVehicleJourneyRef>{draw(st.sampled_from(['J1', 'J2', '']))}</DatedVehicleJourneyRef>"
                         "</FramedVehicleJourneyRef>")
        elif tag in ("RecordedCalls", "EstimatedCalls"):
            calls = []
            for _ in range(draw(st.integers(0, 3))):
                kids = "".join(f"<{c}>{draw(st.sampled_from(['v', '2025-10-27T10:00:00Z', '']))}</{c}>"
                               for c in draw(st.lists(st.sampled_from(CALL_CHILDREN), max_size=4)))
                call = draw(st.sampled_from(["RecordedCall", "EstimatedCall", "Call"]))   # any tag counts
                calls.append(f"<{call}>{kids}</{call}>")
            parts.append(f"<{tag}>{''.join(calls)}</{tag}>")
        elif tag in ("LineRef", "RouteRef"):
            text = draw(st.sampled_from(["", "L1"]))
            ref = draw(st.sampled_from(["", ' ref="R1"']))
            parts.append(f"<{tag}{ref}>{text}</{tag}>")
        else:
            parts.append(f"<{tag}>{draw(st.sampled_from(['a', '']))}</{tag}>")
    if depth < 2 and draw(st.booleans()):
        parts.append(draw(siri_journeys(depth=depth + 1)))                 # a journey nested in a journey
    return f"<EstimatedVehicleJourney>{''.join(parts)}</EstimatedVehicleJourney>"


def siri_tree_walk(content: bytes):
    n = "{http://www.siri.org.uk/siri}"
    out = []
    for j in ET.fromstring(content).iter(n + "EstimatedVehicleJourney"):
        fields = {}
        for c in j:
            tag = c.tag.removeprefix(n)
            if tag in siri.JOURNEY_TEXT:
                fields[tag] = c.text
            if tag in ("LineRef", "RouteRef"):
                fields.update({f"{tag}_text": c.text, f"{tag}_ref": c.get("ref")})
            if tag == "FramedVehicleJourneyRef":
                fields.update({x.tag.removeprefix(n): x.text for x in c if x.tag.removeprefix(n) in ("DataFrameRef", "DatedVehicleJourneyRef")})
        out += [fields | {p.tag.removeprefix(n): p.text for p in call if p.tag.removeprefix(n) in ("StopPointRef", *siri.CALL_TIMES)}
                for box in j.findall(n + "RecordedCalls") for call in box]
    return out


@settings(max_examples=250, deadline=None, suppress_health_check=list(HealthCheck))
@given(journeys=st.lists(siri_journeys(), max_size=4), chunk=st.sampled_from([1, 7, 1 << 16]))
def test_siri_event_reader_equals_tree_walk(journeys, chunk, monkeypatch):
    doc = ('<Siri xmlns="http://www.siri.org.uk/siri" xmlns:o="urn:o"><ServiceDelivery><EstimatedTimetableDelivery>'
           f'<EstimatedJourneyVersionFrame><o:EstimatedVehicleJourney/>{"".join(journeys)}</EstimatedJourneyVersionFrame>'
           '</EstimatedTimetableDelivery></ServiceDelivery></Siri>').encode()
    monkeypatch.setattr(events, "CHUNK", chunk)
    assert siri.walk_document(doc) == siri_tree_walk(doc)
