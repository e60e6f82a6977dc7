"""A small football season as API responses, with the awkward cases in it."""

import json

AREAS = [
    (2267, "World", "INT", None, None),
    (2077, "Europe", "EUR", 2267, "World"),
    (2072, "England", "ENG", 2077, "Europe"),
    (2224, "Spain", "ESP", 2077, "Europe"),
    (2030, "Bosnia and Herzegovina", "BIH", 2077, "Europe"),
    (2192, "Republic of Ireland", "IRL", 2077, "Europe"),
    (2032, "Brazil", "BRA", 2220, "South America"),
    (2145, "Mexico", "MEX", 2170, "N/C America"),
]

COMPETITIONS = [
    (2021, "Premier League", "PL", "LEAGUE", "England"),
    (2001, "UEFA Champions League", "CL", "CUP", "Europe"),
    (2013, "Campeonato Brasileiro Série A", "BSA", "LEAGUE", "Brazil"),
]

SEASON = {2021: 2300, 2001: 2301, 2013: 2302}


def area_payload():
    names = ("id", "name", "countryCode", "parentAreaId", "parentArea")
    return {"count": len(AREAS), "areas": [dict(zip(names, area), flag=None) for area in AREAS]}


def competition_payload():
    return {
        "competitions": [
            {
                "id": i,
                "area": {"id": 1, "name": area},
                "name": name,
                "code": code,
                "type": kind,
                "emblem": "not kept",
                "currentSeason": {"id": SEASON[i], "winner": None},
                "lastUpdated": "2024-01-01T00:00:00Z",
            }
            for i, name, code, kind, area in COMPETITIONS
        ]
    }


def team(ident, name, coach=None, founded=1900, squad=(), colors="Red / White", contract=("2023-07", "2026-06")):
    start, until = contract or (None, None)
    return {
        "id": ident,
        "name": name,
        "shortName": name.split()[0],
        "tla": name[:3].upper(),
        "area": {"id": 2072, "name": "England"},
        "address": f"{name} road",
        "website": None,
        "crest": f"https://crests/{ident}.png",
        "founded": founded,
        "clubColors": colors,
        "venue": f"{name} ground",
        "runningCompetitions": [{"id": 2021, "name": "PL"}] if squad else [],
        "squad": [{"id": i, "name": f"p{i}"} for i in squad],
        "coach": {
            "id": coach,
            "firstName": "A",
            "lastName": "B",
            "name": f"Coach {coach}",
            "dateOfBirth": "1970-02-03",
            "nationality": "Spain",
            "contract": {"start": start, "until": until} if contract else None,
        },
    }


def team_payloads():
    league = [
        team(57, "Arsenal FC", 1, squad=range(100, 112)),
        team(61, "Chelsea FC", 2, squad=range(200, 212), contract=None),
        team(65, "Manchester City FC", 1, squad=range(300, 312), colors=None),
        team(356, "Sheffield United FC", 4, founded=None),
    ]
    europe = [team(61, "Chelsea FC", 2, squad=range(200, 212), contract=None), team(86, "Real Madrid CF", 5, squad=[400])]
    payload = lambda comp, teams, start, end: {
        "count": len(teams),
        "competition": {"id": comp, "name": dict((c[0], c[1]) for c in COMPETITIONS)[comp]},
        "season": {"id": SEASON[comp], "startDate": start, "endDate": end, "winner": None},
        "teams": teams,
    }
    return [
        payload(2021, league, "2024-08-16", "2025-05-25"),
        payload(2001, europe, "2024-07-09", "2025-05-31"),
        payload(2013, [team(1765, "Fluminense FC", 9, squad=[500])], "2025-03-29", "2025-12-21"),
    ]


def match(ident, at, home, away, score, comp=2021, stage="REGULAR_SEASON", status="FINISHED", updated=None, referees=()):
    h, a = score if score else (None, None)
    winner = None if score is None else "HOME_TEAM" if h > a else "AWAY_TEAM" if h < a else "DRAW"
    return {
        "id": ident,
        "utcDate": at,
        "status": status,
        "matchday": 1,
        "stage": stage,
        "lastUpdated": updated or "2025-04-01T00:00:00Z",
        "area": {"id": 2072, "name": "England"},
        "competition": {"id": comp, "name": "x"},
        "season": {"id": SEASON[comp], "winner": None},
        "homeTeam": {"id": home, "name": "h"},
        "awayTeam": {"id": away, "name": "a"},
        "referees": None if referees is None else [{"id": i, "name": f"Ref {i}", "nationality": "France"} for i in referees],
        "score": {
            "winner": winner,
            "duration": "REGULAR",
            "fullTime": {"home": h, "away": a},
            "halfTime": {"home": 0 if score else None, "away": 0 if score else None},
        },
        "odds": "not kept",
    }


def match_payloads():
    first = [
        match(9, "2024-08-17T14:00:00Z", 57, 61, (2, 0), referees=[80747, 11]),
        match(10, "2024-08-18T14:00:00Z", 65, 57, (1, 1)),
        match(11, "2024-08-26T00:00:00Z", 61, 65, (3, 0), referees=None),
        # an older state of the same match
        match(12, "2024-09-01T14:00:00Z", 57, 65, None, status="SCHEDULED", updated="2024-08-30T00:00:00Z"),
    ]
    second = [
        match(12, "2024-09-01T14:00:00Z", 57, 65, (4, 2)),
        match(12, "2024-09-01T14:00:00Z", 57, 65, (4, 2)),
        match(13, "2024-09-14T14:00:00Z", 61, 57, (0, 1), status="AWARDED"),
        match(100, "2024-09-21T14:00:00Z", 65, 61, None, status="IN_PLAY"),
        # plays away only
        match(101, "2024-09-22T14:00:00Z", 57, 356, (1, 0)),
    ]
    europe = [
        match(200, "2024-09-17T19:00:00Z", 86, 61, (3, 1), comp=2001, stage="LEAGUE_STAGE"),
        match(201, "2025-02-11T20:00:00Z", 61, 86, (2, 2), comp=2001, stage="PLAYOFFS"),
        match(202, "2025-05-31T19:00:00Z", 86, 61, None, comp=2001, stage="FINAL", status="TIMED"),
    ]
    # of last year, still delivered by the source
    brazil = [match(300, "2024-06-01T19:00:00Z", 1765, 1, (1, 0), comp=2013), match(301, "2025-04-01T19:00:00Z", 1765, 1, (1, 0), comp=2013)]
    return [{"matches": first}, {"matches": second}, {"matches": europe}, {"matches": brazil}, {"matches": []}]


def person_payloads():
    def person(ident, born, nationality, team_id=57, contract=("2023-07", "2026-06")):
        start, until = contract or (None, None)
        return {
            "id": ident,
            "name": f"Player {ident}",
            "firstName": "P",
            "lastName": None,
            "dateOfBirth": born,
            "nationality": nationality,
            "section": "Offence",
            "position": "Right Winger",
            "shirtNumber": 9,
            "lastUpdated": "2024-06-01T08:00:00Z",
            "currentTeam": {"id": team_id, "contract": {"start": start, "until": until} if contract else None},
        }

    return [
        person(100, "2000-02-29", "England"),
        person(101, "1999-05-02", "USA"),
        person(191106, "1900-01-01", "Spain", 61),
        person(192652, "1990-12-31", None, 86, None),
        person(191811, None, "São Tomé and Príncipe", 7777),
        {"message": "not found", "errorCode": 404},
    ]


def write(folder):
    """One file of JSON lines per endpoint, the matches with a broken line among them."""
    lines = {
        "areas": [area_payload()],
        "competitions": [competition_payload()],
        "teams": team_payloads(),
        "persons": person_payloads(),
        "matches": match_payloads(),
    }
    for name, payloads in lines.items():
        text = [json.dumps(payload, ensure_ascii=False) for payload in payloads]
        if name == "matches":
            text.insert(1, '{"matches": [{"id": 55, "utcDa')
        (folder / f"{name}.json").write_text("\n".join(text) + "\n", encoding="utf-8")
    return folder
