"""Areas of the published collections and codes of places."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# State and country codes of each area.
US_STATES_BY_AREA = {
    "us_northeast": "ct me ma nh ri vt nj ny pa",
    "us_midwest": "il in mi oh wi ia ks mn mo ne nd sd",
    "us_south": "de fl ga md nc sc va dc wv al ky ms ar la ok tx tn",
    "us_west": "az co id mt nv nm ut wy ak ca hi or wa",
}
COUNTRIES_BY_AREA = {
    "europe": "be bg cz dk de ee ie el es fr hr it cy lv lt lu hu mt nl at pl pt ro si sk fi se uk gr gb",
    "asia": "af am az bh bd bt bn kh cn cx cc io ge hk in id ir iq il jp jo kz kp kr kw kg la lb mo my "
    "mv mn mm np om pk ph qa sa sg lk sy tw tj th tr tm ae uz vn ye ps as au nz ck fj pf gu ki mp mh "
    "fm um nr nc nu nf pw pg sb tk to tv vu wf ws is",
    "south_america": "ar bo br cl co ec gf gy pe py sr uy ve",
    "north_america": "ai ag aw bs bb bz bm bq vg ca ky cr cu cw dm do sv gl gd gp gt ht hn jm mq mx pm "
    "ms kn ni pa pr sx lc vc tt tc vi",
}

# Numeric census codes of the states.
STATE_ABBREVIATIONS = {
    "01": "AL", "02": "AK", "04": "AZ", "05": "AR", "06": "CA", "08": "CO", "09": "CT", "10": "DE",
    "11": "DC", "12": "FL", "13": "GA", "15": "HI", "16": "ID", "17": "IL", "18": "IN", "19": "IA",
    "20": "KS", "21": "KY", "22": "LA", "23": "ME", "24": "MD", "25": "MA", "26": "MI", "27": "MN",
    "28": "MS", "29": "MO", "30": "MT", "31": "NE", "32": "NV", "33": "NH", "34": "NJ", "35": "NM",
    "36": "NY", "37": "NC", "38": "ND", "39": "OH", "40": "OK", "41": "OR", "42": "PA", "44": "RI",
    "45": "SC", "46": "SD", "47": "TN", "48": "TX", "49": "UT", "50": "VT", "51": "VA", "53": "WA",
    "54": "WV", "55": "WI", "56": "WY", "72": "PR", "78": "VI",
}


def area_patterns() -> dict[str, str]:
    """Pattern of the source names of each area.

    A state is ``us/xx`` or ``us-xx``, alone or followed by a dot or by the
    same separator; a country is ``xx``, alone or followed by ``.``, ``/``, ``-``.
    """
    patterns = {"global": "^"}
    for area, codes in US_STATES_BY_AREA.items():
        patterns[area] = rf"^us([/-])(?:{'|'.join(codes.split())})(?:$|\.|\1)"
    for area, codes in COUNTRIES_BY_AREA.items():
        patterns[area] = rf"^(?:{'|'.join(codes.split())})(?:$|[./-])"
    return patterns


def areas_of(source_base: Column) -> Column:
    """All areas a source belongs to, as an array."""
    hits = [F.when(source_base.rlike(p), F.lit(a)) for a, p in area_patterns().items()]
    return F.array_compact(F.array(*hits))


def state_abbreviation(census_code: Column) -> Column:
    pairs = [F.lit(x) for item in STATE_ABBREVIATIONS.items() for x in item]
    return F.try_element_at(F.create_map(*pairs), census_code)


def guess_country(iso: Column, iso_sub: Column, geoid: Column, paths: Column) -> Column:
    """Country code from the first of four hints that is filled."""
    filled = lambda c: F.coalesce(c != "", F.lit(False))
    return (
        F.when(filled(iso), iso)
        .when(filled(iso_sub), F.split(iso_sub, "-")[0])
        .when(filled(geoid), F.lit("US"))
        .when(filled(paths), F.try_element_at(F.split(F.upper(paths), "/"), F.lit(2)))
    )


def guess_state(geoid: Column, paths: Column) -> Column:
    """State code from the census code, else from a ``sources/us/xx/...`` path."""
    filled = lambda c: F.coalesce(c != "", F.lit(False))
    parts = F.split(F.upper(paths), "/", 4)
    by_path = F.when((F.size(parts) == 4) & (parts[1] == "US"), F.try_element_at(parts, F.lit(3)))
    return F.when(filled(geoid), state_abbreviation(F.upper(F.substring(geoid, 1, 2)))).when(
        filled(paths), by_path
    )


def coverage_band(fraction: Column) -> Column:
    return F.when(fraction > 0.98, F.lit("best")).when(fraction > 0.15, F.lit("okay")).otherwise(F.lit("empty"))
