"""Hand-written match files (see FIXTURES.md section 2)."""

import os

FILE_0001 = (
    'Div,Date,HomeTeam,AwayTeam,FTHG,FTAG,FTR,HTHG,HTAG,HTR,Referee,B365H,B365D,B365A,,\n'
    'E0,19/08/00,Ash,Birch,3,1,H,2,1,H,"Doe, J",1.50,4.00,6.00,,\n'
    'E0,20/08/00,Cedar,Elm,2,2,D,1,1,D,Roe K,2.20,3.10,3.20,,\n'
    'E0,21/08/00,Fir,Hazel,1,2,A,1,2,A,Poe L,,3.40,2.00,,\n'
)
FILE_0102 = (
    'Div,Date,HomeTeam,AwayTeam,FTHG,FTAG,FTR,HTHG,HTAG,HTR,GBH,GBD,GBA,XYZ\n'
    'E0,18/08/01,Ash,Elm,2,1,H,1,2,A,1.80,3.30\n'
    'E0,19/08/01,Birch,Fir,4,1,H,3,1,H,1.30,5.00,9.00,7,extra,extra\n'
    '\n'
    'E0,20/08/01,Cedar,Hazel,1,3,A,1,2,A,,,,'
)

MERGED = ["FTHG", "FTAG", "FTR", "HTHG", "HTAG", "HTR", "GBH", "GBD", "GBA", "XYZ",
          "B365H", "B365D", "B365A"]

# (FTHG, FTAG, FTR, HTHG, HTAG, HTR, GBH, GBD, GBA, XYZ, B365H, B365D, B365A)
EXPECTED = [
    (3.0, 1.0, 1.0, 2.0, 1.0, 1.0, None, None, None, None, 1.5, 4.0, 6.0),
    (2.0, 2.0, 0.0, 1.0, 1.0, 0.0, None, None, None, None, 2.2, 3.1, 3.2),
    (1.0, 2.0, -1.0, 1.0, 2.0, -1.0, None, None, None, None, None, 3.4, 2.0),
    (2.0, 1.0, 1.0, 1.0, 2.0, -1.0, 1.8, 3.3, None, None, None, None, None),
    (4.0, 1.0, 1.0, 3.0, 1.0, 1.0, 1.3, 5.0, 9.0, 7.0, None, None, None),
    (1.0, 3.0, -1.0, 1.0, 2.0, -1.0, None, None, None, None, None, None, None),
]


def write_raw(root: str) -> str:
    os.makedirs(os.path.join(root, "0001"), exist_ok=True)
    os.makedirs(os.path.join(root, "0102"), exist_ok=True)
    with open(os.path.join(root, "0001", "E0.csv"), "w") as f:
        f.write(FILE_0001)
    with open(os.path.join(root, "0102", "E0.csv"), "w") as f:
        f.write(FILE_0102)
    with open(os.path.join(root, "0102", "notes.txt"), "w") as f:
        f.write("not a match file\n")
    return root


BOOKMAKERS = ["B365", "BW", "GB", "IW", "LB", "SB", "WH", "VC"]


def write_football_seasons(root: str, seasons=(2000, 2001, 2002), divisions=("E0", "E1"),
                           rows=60, seed=7) -> str:
    """Seeded football-style season files for end-to-end tests: identity
    and in-match columns, labels, win/draw/loss odds of a season-dependent
    set of bookmakers, plus excluded families (averages, over/under)."""
    import numpy as np
    rng = np.random.default_rng(seed)
    for y in seasons:
        code = f"{y % 100:02d}{(y + 1) % 100:02d}"
        os.makedirs(os.path.join(root, code), exist_ok=True)
        books = BOOKMAKERS[: 4 + (y - seasons[0]) * 2]
        header = (["Div", "Date", "HomeTeam", "AwayTeam", "FTHG", "FTAG", "FTR", "HTHG", "HTAG",
                   "HTR", "Referee", "HS", "AS"]
                  + [f"{b}{r}" for b in books for r in "HDA"]
                  + ["BbAvH", "BbAvD", "BbAvA", "BbMx>2.5"])
        for div in divisions:
            lines = [",".join(header)]
            for i in range(rows):
                strength = rng.normal()
                fthg, ftag = rng.poisson(1.4 + 0.3 * strength), rng.poisson(1.1 - 0.2 * strength)
                hthg, htag = rng.binomial(fthg, 0.45), rng.binomial(ftag, 0.45)
                res = lambda a, b: "H" if a > b else ("A" if a < b else "D")
                odds = []
                for _ in books:
                    h = max(1.05, 2.4 - 0.6 * strength + rng.normal(0, 0.1))
                    odds += [f"{h:.2f}", f"{3.3 + rng.normal(0, 0.1):.2f}",
                             f"{max(1.05, 3.0 + 0.8 * strength + rng.normal(0, 0.1)):.2f}"]
                if i % 17 == 3:
                    odds[1] = ""                     # a blank odds cell
                row = ([div, f"{(i % 28) + 1:02d}/08/{y % 100:02d}", f"T{i % 20}",
                        f"T{(i + 7) % 20}", str(fthg), str(ftag), res(fthg, ftag), str(hthg),
                        str(htag), res(hthg, htag), '"Ref, A"', str(rng.integers(5, 20)),
                        str(rng.integers(5, 20))] + odds + ["2.1", "3.2", "3.4", "1.9"])
                lines.append(",".join(row))
            with open(os.path.join(root, code, f"{div}.csv"), "w") as f:
                f.write("\n".join(lines) + "\n")
    return root
