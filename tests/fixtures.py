"""Hand-made insurance tables covering every null case of the document.

Policies: (1) complete; (2) no claim, no receipt; (3) claim without payment,
two equal receipts; (4) no tariff, so dropped; (5) no participant, so dropped.
Plus a claim with a null policy key, a participant whose client is missing,
a client without account and a payment whose claim is missing.
"""

from __future__ import annotations

from nestdoc.sources.schemas import SCHEMAS

OPEN = "9999-12-31"

ROWS = {
    "policies": [
        (1, "PV", "2021-01-10", "2021-01-09", "2025-01-10", "A", OPEN, " ", OPEN, " "),
        (2, "PA", "2021-02-10", "2021-02-09", "2026-02-10", "M", "2021-06-01", "FP", OPEN, " "),
        (3, "PS", "2021-03-10", "2021-03-09", "2027-03-10", "T", OPEN, " ", "2021-07-01", "CL"),
        (4, "PV", "2021-04-10", "2021-04-09", "2028-04-10", "S", OPEN, " ", OPEN, " "),
        (5, "PV", "2021-05-10", "2021-05-09", "2029-05-10", "U", OPEN, " ", OPEN, " "),
    ],
    "claims": [
        (10, 1, "2021-03-01", "2021-03-02", OPEN, "FA", "AB"),
        (11, 1, "2021-04-01", "2021-04-03", "2021-05-01", "IN", "CE"),
        (12, 3, "2021-05-01", "2021-05-02", OPEN, "RE", "AB"),
        (13, None, "2021-06-01", "2021-06-02", OPEN, "RE", "AB"),
    ],
    "payments": [
        (100, 10, "CO", "2021-03-05", 150.0, "T"),
        (101, 10, "AN", OPEN, 99.5, "E"),
        (102, 11, "CO", "2021-04-05", 1000.0, "T"),
        (103, 99, "CO", "2021-04-06", 5.0, "T"),
    ],
    "receipts": [
        (1000, "2021-01-09", "2021-01-10", 1, "CO", "MA", 300.0, 3.0, 2.0),
        (1001, "2021-03-09", "2021-03-10", 3, "AN", "AU", 50.0, 1.0, 1.0),
        (1001, "2021-03-09", "2021-03-10", 3, "AN", "AU", 50.0, 1.0, 1.0),
        (1002, "2021-05-09", "2021-05-10", 5, "CO", "MA", 70.0, 1.0, 1.0),
    ],
    "tariffs": [
        (1, "TS1", "A", "2021-01-10", OPEN, "500"),
        (1, "TF1", "A", "2021-01-10", OPEN, "0"),
        (2, "TS1", "B", "2021-02-10", "2021-06-01", "700"),
        (3, "TF1", "A", "2021-03-10", OPEN, "800"),
        (5, "TS1", "A", "2021-05-10", OPEN, "900"),
    ],
    "clients": [
        (7, "Ana", "Lopez Diaz", "1980-01-01", "Calle 1; 2", "12345678A"),
        (8, "Luis", "Perez Gil", "1975-05-05", "Calle 3; 4", "87654321B"),
    ],
    "accounts": [
        (70, 7, "0049", "0001", "123", "456789012", "A", "2010-01-01", OPEN, "ES0000490001123456789012"),
        (71, 7, "2100", "0002", "321", "210987654", "B", "2011-01-01", "2015-01-01", "ES0021000002321210987654"),
    ],
    "participants": [
        (7, 1, "AS", "B", "2021-01-10", OPEN, "1"),
        (8, 2, "AS", "A", "2021-02-10", "2021-06-01", "1"),
        (9, 3, "AS", "A", "2021-03-10", "2021-07-01", "1"),
        (7, 4, "AS", "B", "2021-04-10", OPEN, "1"),
    ],
}


def tables(spark):
    return {name: spark.createDataFrame(rows, SCHEMAS[name]) for name, rows in ROWS.items()}
