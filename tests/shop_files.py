"""Day partitions as CSV files, and a plain model of ordered daily runs."""

from __future__ import annotations

import csv
import json
import random
from collections import defaultdict
from pathlib import Path

from marketlane.schemas import LANDING_COLUMNS


def uid(kind: str, n: int) -> str:
    """Canonical UUID text."""
    return f"{ord(kind[0]):08x}-0000-4000-8000-{n:012x}"


def write_day(root: Path, ds: str, manifest: dict | None = None, **entities: list[dict]) -> None:
    folder = root / ds
    folder.mkdir(parents=True, exist_ok=True)
    counts = {}
    for entity, rows in entities.items():
        with open(folder / f"{entity}.csv", "w", newline="") as f:
            out = csv.DictWriter(f, LANDING_COLUMNS[entity])
            out.writeheader()
            out.writerows(rows)
        counts[entity] = len(rows)
    (folder / "manifest.json").write_text(json.dumps({**counts, **(manifest or {})}))


def write_categories(root: Path) -> None:
    root.mkdir(parents=True, exist_ok=True)
    with open(root / "categories.csv", "w", newline="") as f:
        out = csv.DictWriter(f, LANDING_COLUMNS["categories"])
        out.writeheader()
        out.writerows(
            [
                {"category_id": "1.0", "name": "Книги", "parent_id": ""},
                {"category_id": "2.0", "name": "Комиксы", "parent_id": "1.0"},
                {"category_id": "3.0", "name": "Бизнес", "parent_id": "1.0"},
            ]
        )


def user(n: int, ds: str, **changed) -> dict:
    row = {
        "user_id": uid("u", n), "email": f"u{n}@x.example", "full_name": f"User, {n}",
        "registration_date": ds, "acquisition_channel": "organic", "city": f"City {n % 3}",
        "age_group": "25-34", "is_active": "True",
    }
    return {**row, **changed}


def product(n: int, ds: str, **changed) -> dict:
    row = {
        "product_id": uid("p", n), "name": f'Item "{n}"', "category_id": f"{2 + n % 2}.0",
        "price": f"{10 + n}.50", "cost_price": "5.25", "rating": "4.5", "is_available": "True",
        "created_at": f"{ds} 00:00:00",
    }
    return {**row, **changed}


def order(n: int, user_n: int | None, ds: str, **changed) -> dict:
    row = {
        "order_id": uid("o", n), "user_id": "" if user_n is None else uid("u", user_n),
        "created_at": f"{ds} 10:00:00", "status": "completed", "payment_method": "card",
        "total_amount": "100.00", "discount_amount": "", "promo_code": "",
    }
    return {**row, **changed}


def item(n: int, order_n: int, product_n: int | None, quantity: int = 2, **changed) -> dict:
    row = {
        "order_item_id": uid("i", n), "order_id": uid("o", order_n),
        "product_id": "" if product_n is None else uid("p", product_n),
        "quantity": str(quantity), "unit_price": "50.00",
    }
    return {**row, **changed}


def payment(n: int, order_n: int, ds: str, **changed) -> dict:
    row = {
        "payment_id": uid("y", n), "order_id": uid("o", order_n), "amount": "100.00",
        "method": "card", "status": "succeeded", "processed_at": f"{ds} 10:01:00",
    }
    return {**row, **changed}


def event(user_n: int, session: int, kind: str, ts: str, product_n: int = 1) -> dict:
    return {
        "user_id": uid("u", user_n), "session_id": uid("s", session), "product_id": uid("p", product_n),
        "event_type": kind, "created_at": ts,
    }


def random_history(seed: int, days: list[str], scale: int = 40) -> dict[str, dict[str, list[dict]]]:
    """Dirty days: late dimensions, repeated orders within and across days, bad items."""
    rng = random.Random(seed)
    history = {ds: defaultdict(list) for ds in days}
    for n in range(scale):
        first = rng.randrange(len(days))
        history[days[first]]["users"].append(user(n, days[first]))
        if rng.random() < 0.3 and first + 1 < len(days):
            history[days[first + 1]]["users"].append(user(n, days[first], email=f"new{n}@x.example", city="Moved"))
        first = rng.randrange(len(days))
        history[days[first]]["products"].append(product(n, days[first]))
    pay = 0
    for n in range(scale * 3):
        d = rng.randrange(len(days))
        who = None if rng.random() < 0.05 else rng.randrange(scale + 3)
        row = order(n, who, days[d])
        history[days[d]]["orders"].append(row)
        if rng.random() < 0.15:
            history[days[d]]["orders"].append({**row, "created_at": f"{days[d]} 10:{rng.randrange(1, 30):02d}:00"})
        if rng.random() < 0.15 and d + 1 < len(days):
            history[days[d + 1]]["orders"].append({**row, "created_at": f"{days[d + 1]} 09:00:00"})
        if rng.random() < 0.8:
            history[days[d]]["payments"].append(payment(pay, n, days[d]))
            pay += 1
    for n in range(scale * 8):
        d = rng.randrange(len(days))
        what = None if rng.random() < 0.05 else rng.randrange(scale + 3)
        row = item(n, rng.randrange(scale * 3 + 5), what, rng.choice([-1, 1, 2, 3]))
        history[days[d]]["order_items"].append(row)
        if rng.random() < 0.1:
            history[rng.choice(days)]["order_items"].append(row)
    for n in range(scale * 5):
        d = rng.randrange(len(days))
        ts = f"{days[d]} {rng.randrange(24):02d}:{rng.randrange(60):02d}:00"
        history[days[d]]["events"].append(event(n % scale, n % (scale * 2), rng.choice(["view", "cart", "purchase"]), ts))
    return history


def ordered_runs(history: dict[str, dict[str, list[dict]]]):
    """Core keys with their day, and rejects, when days are loaded one after another."""
    users, products, core = set(), set(), {"orders": {}, "order_items": {}, "payments": {}}
    rejects = []
    for ds in sorted(history):
        day = history[ds]
        users |= {r["user_id"] for r in day["users"]}
        products |= {r["product_id"] for r in day["products"]}
        seen = set()
        for r in sorted(day["orders"], key=lambda r: r["created_at"]):
            if not r["user_id"]:
                rejects.append(("orders", ds, "null_user_id", r["order_id"]))
            elif r["user_id"] not in users:
                rejects.append(("orders", ds, "orphan_user", r["order_id"]))
            elif r["order_id"] in seen:
                rejects.append(("orders", ds, "duplicate_pk", r["order_id"]))
            else:
                seen.add(r["order_id"])
                core["orders"].setdefault(r["order_id"], (ds, r["created_at"]))
        for r in day["order_items"]:
            reason = (
                "null_product_id" if not r["product_id"]
                else "orphan_product" if r["product_id"] not in products
                else "negative_quantity" if int(r["quantity"]) <= 0
                else "orphan_order" if r["order_id"] not in core["orders"]
                else None
            )
            if reason:
                rejects.append(("order_items", ds, reason, r["order_item_id"]))
            else:
                core["order_items"].setdefault(r["order_item_id"], ds)
        for r in day["payments"]:
            if r["order_id"] not in core["orders"]:
                rejects.append(("payments", ds, "orphan_order", r["payment_id"]))
            else:
                core["payments"].setdefault(r["payment_id"], ds)
    return core, sorted(rejects)
