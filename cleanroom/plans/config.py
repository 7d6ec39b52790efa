"""Shipped configuration: column rules, script rules, document mapping, sheets.

All values here are fixed values of the data model (names are ours).
"""

from __future__ import annotations

import json
from pathlib import Path

RULES = {
    "catalog": {
        "title": {"required": True, "max_length": 255},
        "author": {"required": True, "max_length": 255},
        "category_and_description": {"required": True, "must_contain": "|"},
        "publisher": {"required": True, "max_length": 255},
        "published": {"required": True, "type": "date", "max_date": "today"},
    },
    "loans": {
        "loan_id": {"required": True, "type": "integer"},
        "user_name": {"required": True, "max_length": 255},
        "email": {"required": True, "regex": r"^[^@\s]+@[^@\s]+\.[^@\s]+$"},
        "borrowed": {"required": True, "no_empty_items_csv": True},
        "checkout": {"required": True, "type": "date"},
        "status": {"required": True, "allowed_values": ["ACTIVO", "DEVUELTO", "VENCIDO"]},
    },
    "stock": {
        "branch": {"required": True, "max_length": 100},
        "location": {"required": True, "max_length": 255},
        "title": {"required": True, "max_length": 255},
        "quantity": {"required": True, "type": "integer", "min": 0},
    },
    "reviews": {
        "user_ref": {"required": True, "type": "integer"},
        "title": {"required": True, "max_length": 255},
        "comment": {"required": False, "max_length": 1000},
        "rating": {"required": True, "type": "integer", "min": 1, "max": 5},
    },
}

SCRIPT_RULES = {
    "forbidden_keywords": ["DROP DATABASE", "TRUNCATE"],
    "avoid_text_fields": True,
    "require_primary_keys": True,
}

# Raw columns: (name, longest text the raw table takes; None = any; "int" = INT).
RAW_COLUMNS = {
    "catalog": [
        ("title", 255), ("author", 255), ("category_and_description", None),
        ("publisher", 255), ("published", 50),
    ],
    "loans": [
        ("loan_id", "int"), ("user_name", 255), ("email", 255), ("borrowed", None),
        ("checkout", 50), ("status", 20),
    ],
    "stock": [("branch", 100), ("location", 255), ("title", 255), ("quantity", 50)],
    "reviews": [("user_ref", 50), ("title", 255), ("comment", None), ("rating", 10)],
}

# Collection -> projection.  ``via`` names the join column, or the link table and
# its two columns for a many-to-many embed.
MAPPING = {
    "books": {
        "source": "items",
        "primary_key": "item_id",
        "fields": {"item_id": "book_id", "title": "title", "published": "published_at"},
        "embedded": {
            "category": {
                "source": "categories",
                "fields": {"name": "name", "description": "description"},
                "via": "category_id",
            },
            "publisher": {
                "source": "publishers",
                "fields": {"name": "name"},
                "via": "publisher_id",
            },
            "authors": {
                "source": "authors",
                "fields": {"name": "name"},
                "via": ["item_authors", "item_id", "author_id"],
            },
        },
    },
    "users": {
        "source": "users",
        "primary_key": "user_id",
        "fields": {"user_id": "user_id", "name": "name", "email": "email"},
        "masked": ["email"],
    },
    "loans": {
        "source": "loans",
        "primary_key": "loan_id",
        "fields": {
            "loan_id": "loan_id", "checkout": "checkout_date",
            "returned": "return_date", "status": "status",
        },
        "references": {"user_id": "user_id", "item_id": "book_id"},
    },
    "inventory": {
        "source": "stock",
        "fields": {"quantity": "total_quantity"},
        "references": {"branch_id": "branch_id", "item_id": "book_id"},
    },
}

# Tables of the masked export and the headers it shows where they differ.
EXPORT_TABLES = ["items", "authors", "users", "loans", "stock", "reviews"]
EXPORT_HEADERS = {
    "items": {"published": "fecha_publicacion"},
    "users": {"email": "correo"},
    "loans": {"checkout": "fecha_salida", "returned": "fecha_devolucion"},
    "reviews": {"created": "fecha_resena"},
}


def load(path: str | Path) -> dict:
    """Rules or a mapping from a JSON file."""
    return json.loads(Path(path).read_text(encoding="utf-8"))
