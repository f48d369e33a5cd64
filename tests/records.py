"""Records that several tests build on."""


def posting(**fields):
    """A bronze row of the second generation, with overrides."""
    row = {"board": "board_1", "schema_gen": "gen_b", "exported_at": "2026-08-01T00:00:00", "Id": "1",
           "Title": "Cook", "CompanyName": "Acme", "Status": "Active", "CreatedAt": "2026-07-01T00:00:00"}
    row.update(fields)
    return row
