"""A small landing zone with invented people, written as the extracts write it."""

import json
import os


def write_pages(root, entity, tenant, *pages, date=None, name="part", at=None):
    """``at`` sets the time the file arrived."""
    folder = root / entity / f"tenant={tenant}"
    if date:
        folder = folder / f"date={date}"
    folder.mkdir(parents=True, exist_ok=True)
    lines = [json.dumps({"data": page}) for page in pages]
    file = folder / f"{name}.json"
    file.write_text("\n".join(lines) + "\n")
    if at is not None:
        os.utime(file, (at, at))


def employee(key, company, **fields):
    base = {
        "id": key,
        "firstName": f"First {key}",
        "lastName": f"Last {key}",
        "email": f"{key}@example.org",
        "status": "active",
        "nid": f"N-{key}",
        "company": {"id": f"ID-{company}-x", "name": f"{company} SL "},
        "pricePerHour": 20.0,
        "postalCode": "01234",
        "customFields": [
            {"slug": "cf_rea", "value": "Field work"},
            {"slug": "cf_precioh_empresa", "value": "12,5"},
            {"slug": "cf_fecha_de_alta", "value": "03/02/2020"},
            {"slug": "cf_fecha_de_baja", "value": "2023-11-30"},
        ],
    }
    return {**base, **fields}


def time_entry(key, person, start, end, project="p1", tags=("a", "b"), comment="did things"):
    return {
        "id": key,
        "employee": {"id": person},
        "project": {"id": project} if project else None,
        "timeEntryIn": {"date": start},
        "timeEntryOut": {"date": end},
        "tags": {"data": [{"name": t} for t in tags]},
        "comment": comment,
    }


def assignment(key, person, department, updated):
    return {
        "id": key,
        "employee": {"id": person, "company": {"id": "c", "name": "C"}},
        "department": {"id": department, "name": f"Area {department}"},
        "createdAt": "2023-01-01T08:00:00+01:00",
        "updatedAt": updated,
    }


def hours(person, worked, to_work=28800):
    balance = (worked or 0) - to_work
    return {"employeeId": person, "secondsWorked": worked, "secondsToWork": to_work, "secondsBalance": balance}


def write_all(root):
    write_pages(
        root,
        "employees",
        "north",
        [employee("e1", "Acme"), employee("e2", "Acme", status="inactive", gender=None, nid=None, customFields=[])],
        [employee("e3", "Bolt", children=2)],
    )
    write_pages(root, "employees", "south", [employee("e4", "Nobody"), employee("e5", "Bolt", status="candidate")])
    write_pages(root, "departments", "north", [{"id": "d1", "name": "Sales"}, {"id": "d2", "name": "Works"}])
    write_pages(
        root,
        "department_assignments",
        "north",
        [assignment("a1", "e1", "d1", "2024-01-01T10:00:00+01:00"), assignment("a2", "e1", "d2", "2024-01-02T10:00:00Z")],
        [assignment("a3", "e3", "d9", "2024-01-02T10:00:00Z")],
    )
    write_pages(
        root,
        "projects",
        "south",
        [
            {
                "id": "p1",
                "name": "Bridge",
                "customer": {"id": "c1", "customerName": "Town"},
                "projectStatus": {"value": "open"},
            },
            {"id": "p2", "name": "Own", "customer": None, "projectStatus": {"value": "closed"}},
        ],
    )
    write_pages(
        root,
        "time_entries",
        "north",
        [time_entry("t0", "e1", "2023-06-01T08:00:00Z", "2023-06-01T10:00:00Z")],
        date="2023-06-01",
    )
    write_pages(
        root,
        "time_entries",
        "north",
        [
            time_entry("t1", "e1", "2024-01-10T08:00:00+01:00", "2024-01-10T09:30:00+01:00", comment="x" * 300),
            time_entry("t2", "e1", "2024-01-11T00:30:00+01:00", "2024-01-11T01:15:00+01:00", project=None, tags=()),
            time_entry("t3", "e9", "2024-01-12T08:00:00Z", "2024-01-12T09:00:00Z", project="p2", comment=None),
        ],
        date="2024-01-11",
    )
    write_pages(
        root,
        "time_entries",
        "south",
        [time_entry("t4", "e3", "2024-02-01T08:00:00Z", "2024-02-01T10:00:00Z", "p9", tags=(), comment=None)],
        date="2024-02-01",
    )
    write_pages(root, "worked_hours", "north", [hours("e1", 3600), hours("e1", None), hours(None, 60)], date="2024-01-10")
    write_pages(root, "worked_hours", "south", [hours("e3", 7200)], date="2024-01-11")
    write_pages(root, "worked_hours", "south", [hours("e3", 100)], date="2024-03-01")
