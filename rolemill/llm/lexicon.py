"""Other words for the entries of the reference list: a default that callers can replace.

Spelling, case, spacing, order and typing errors are left to the rules in canon.py; here stand only other names of the
same thing.
"""

from __future__ import annotations

# Term -> other names, by field.
SYNONYMS: dict[str, dict[str, str]] = {
    "industry": {
        "software": "software dev, software development, computer software, software & internet, saas",
        "health care": "hospitals, medical services, hc",
        "logistics": "freight, supply chain, shipping & warehousing, transport/logistics",
        "banking": "banks, bank sector, retail banking",
        "insurance": "ins, insurer, insurance carriers, underwriting",
        "retail": "retail trade, shops, brick-and-mortar stores",
        "manufacturing": "mfg, manuf, factory, industrial production",
        "energy": "utilities & power, oil & gas, renewable energy",
        "education": "edu, edtech, higher ed, schools",
        "construction": "constr, building trades, civil construction",
        "hospitality": "hotels, lodging, hotels and restaurants",
        "telecommunications": "telecom, telecoms, telco, mobile networks",
        "pharmaceuticals": "pharma, drug makers",
        "aerospace": "aero, aviation, space & aviation",
        "agriculture": "ag, agri, agribusiness, farming",
        "real estate": "realty, property management",
        "media": "publishing, news media, broadcast media",
        "government": "gov, govt, public sector, public administration",
        "nonprofit": "ngo, charity, not-for-profit, non profit org",
        "consulting": "consultants, advisory services, management consultancy",
        "cybersecurity": "infosec, cyber sec, information security",
        "automotive": "auto, car industry, vehicles",
        "food production": "f&b manufacturing, food & beverage, food industry",
        "staffing": "recruitment agency, temp agency, employment services",
        "biotechnology": "biotech, bio tech, life sciences",
        "gaming": "game dev, games industry, video games",
    },
    "seniority_level": {
        "intern": "internship, summer intern, co-op, trainee",
        "entry level": "entry, early career, graduate, new grad",
        "mid level": "mid, intermediate",
        "senior": "sr, snr",
        "principal": "prin, princ",
        "team lead": "lead, team leader, tech lead",
        "manager": "mgr, managerial, people manager",
        "director": "dir, head of department",
        "executive": "exec, vp, vice president, c-level, c-suite",
    },
    "required_skills": {
        "python": "py",
        "javascript": "js, ecmascript, es6",
        "typescript": "ts",
        "c++": "cpp, c plus plus",
        "c#": "c sharp, csharp, c# .net",
        "go": "golang",
        "rust": "rustlang",
        "kotlin": "kotlin/jvm",
        "sql": "structured query language, ansi sql",
        "postgresql": "postgres, pg, psql, postgre sql",
        "mongodb": "mongo",
        "elasticsearch": "es cluster",
        "react": "reactjs",
        "angular": "angularjs",
        "vue": "vuejs",
        "node.js": "node",
        "django": "python-django",
        "docker": "dockerised apps",
        "kubernetes": "k8s, kube, container orchestration (k8s)",
        "terraform": "tf (terraform), hashicorp-style terraform",
        "amazon web services": "aws, amazon aws",
        "google cloud platform": "gcp, google cloud",
        "microsoft azure": "azure",
        "apache spark": "spark, spark sql, pyspark",
        "apache kafka": "kafka",
        "apache airflow": "airflow",
        "machine learning": "ml, statistical learning (ml)",
        "deep learning": "dl, deep nets, deep neural networks",
        "natural language processing": "nlp, text mining / nlp",
        "computer vision": "cv (vision), image recognition",
        "data visualization": "data viz, dataviz",
        "statistics": "stats, applied statistics, statistical analysis",
        "microsoft excel": "excel, advanced excel",
        "power bi": "ms power bi",
        "continuous integration": "ci, ci/cd",
        "version control": "git, git/svn, source control",
        "linux": "gnu/linux, unix/linux",
        "project management": "pm (project), managing projects",
        "agile methods": "agile, scrum, agile/scrum",
        "customer service": "customer support, client service",
        "financial modeling": "finance models",
        "bookkeeping": "accounts bookkeeping",
        "forklift operation": "forklift, fork lift driving",
        "patient care": "bedside care, care of patients",
        "first aid": "cpr & first aid",
        "technical writing": "documentation writing",
        "public speaking": "presentations, presentation skills",
        "user research": "ux research, user interviews, usability testing",
        "network security": "netsec, security of networks",
        "quality assurance": "qa, quality control/qa",
        "inventory management": "inventory control, stock management",
        "supply chain planning": "supply planning, scm planning",
        "negotiation": "negotiating, contract negotiation",
        "copywriting": "ad copy",
        "electrical wiring": "electrics, wiring",
        "computer aided design": "cad, autocad-style drafting",
    },
}

# Words that add nothing to the name of a skill, level or industry they stand with.
QUALIFIERS = frozenset(
    "programming lang language framework cache playbooks containers desktop dashboards jvm dags streams queries cluster admin drafting pipelines cloud level industry cert certified developer knowledge basics required preferred".split()
)

# Short forms of single words.
SHORT = {"mgmt": "management", "svc": "service", "cust": "customer", "fin": "financial", "ms": "microsoft", "pt": "patient", "tech": "technical", "modelling": "modeling", "visualisation": "visualization", "graphics": "graphic", "sec": "security"}
