"""Small sequential versions of the operators, written for comparison on fixtures only."""

import math

import numpy as np


def km(lat1, lon1, lat2, lon2):
    s = math.sin(math.radians(lat2 - lat1) / 2)
    t = math.sin(math.radians(lon2 - lon1) / 2)
    a = min(s * s + math.cos(math.radians(lat1)) * math.cos(math.radians(lat2)) * t * t, 1.0)
    return 6371.0 * 2 * math.asin(math.sqrt(a))


def km_to_all(lat, lon, lats, lons):
    s = np.sin(np.radians(lats - lat) / 2)
    t = np.sin(np.radians(lons - lon) / 2)
    a = np.minimum(s * s + np.cos(np.radians(lat)) * np.cos(np.radians(lats)) * t * t, 1.0)
    return 6371.0 * 2 * np.arctan2(np.sqrt(a), np.sqrt(1 - a))


def thin(cands, limit):
    """cands: data frame with cand_ord, lat, lon, darkness, bortle; returns kept cand_ord in scan order."""
    order = cands.sort_values(["darkness", "cand_ord"], ascending=[False, True])
    kept = []
    rows = order.to_dict("records")
    by_class = {}
    for r in rows:
        group = by_class.setdefault(r["bortle"] if r["bortle"] == r["bortle"] else None, ([], []))
        if group[0] and (km_to_all(r["lat"], r["lon"], np.array(group[0]), np.array(group[1])) < limit).any():
            continue
        group[0].append(r["lat"])
        group[1].append(r["lon"])
        kept.append(int(r["cand_ord"]))
    return kept


def cover(kept, mesh, places, min_spots, radius):
    """Ordered (cand_ord, added_by) of the sites added for places in place_ord order."""
    used = set(kept["cand_ord"])
    lat, lon = list(kept["lat"]), list(kept["lon"])
    mesh = mesh.sort_values(["darkness", "cand_ord"], ascending=[False, True])
    added = []
    for p in places.sort_values("place_ord").to_dict("records"):
        within = int((km_to_all(p["lat"], p["lon"], np.array(lat), np.array(lon)) <= radius).sum()) if lat else 0
        needed = min_spots - within
        if needed <= 0:
            continue
        near = km_to_all(p["lat"], p["lon"], mesh["lat"].to_numpy(), mesh["lon"].to_numpy()) <= radius
        pool = [r for r in mesh[near].to_dict("records") if r["cand_ord"] not in used][:needed]
        for r in pool:
            used.add(r["cand_ord"])
            lat.append(r["lat"])
            lon.append(r["lon"])
            added.append((int(r["cand_ord"]), int(p["place_ord"])))
    return added
