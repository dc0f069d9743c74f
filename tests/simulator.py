"""The rules of a card, row by row in plain Python; what the window plans are held against."""

from __future__ import annotations

from collections import defaultdict


def facts(rows, velocity_s=60, probes=3, probe_max=500, large_min=50000, testing_s=300,
          forget_s=604800):
    """rows: dicts with transaction_id, card_id, event_ms, amount_minor, country_code.

    Returns transaction_id -> (velocity_count, prior_count, prior_total, prev_country,
    prev_ms, sorted list of (first_ms, total_minor)).
    """
    cards = defaultdict(list)
    for r in rows:
        cards[r["card_id"]].append(r)
    out = {}
    for card_rows in cards.values():
        card_rows = sorted(card_rows, key=lambda r: (r["event_ms"], r["transaction_id"]))
        times, count, total, place, place_ms = [], 0, 0, None, None
        small, waiting = [], []
        for r in card_rows:
            ms, amount = r["event_ms"], r["amount_minor"]
            if place_ms is not None and ms - place_ms > forget_s * 1000:
                times, count, total, place, place_ms, small, waiting = [], 0, 0, None, None, [], []
            times = [t for t in times if t > ms - velocity_s * 1000] + [ms]
            matches = []
            if amount >= large_min:
                matches = sorted((first, run) for first, run in waiting if ms - first < testing_s * 1000)
                waiting = []
            out[r["transaction_id"]] = (len(times), count, total, place, place_ms, matches)
            if amount <= probe_max:
                small.append((ms, amount))
                if len(small) >= probes:
                    run = small[-probes:]
                    waiting.append((run[0][0], sum(a for _, a in run)))
            count, total, place, place_ms = count + 1, total + amount, r["country_code"], ms
    return out
