"""Rule tables of topic normalisation; every table is a parameter of the functions that use it."""

# Names that stand for one topic.
CONSOLIDATION = {
    "email": "Email",
    "email management": "Email",
    "email migration": "Email",
    "email forwarding": "Email",
    "exchange email": "Email",
    "outlook": "Email",
    "two-step login": "Authentication",
    "two-factor authentication": "Authentication",
    "multi-factor authentication": "Authentication",
    "password": "Authentication",
    "password management": "Authentication",
    "password reset": "Authentication",
    "network storage": "Network Storage",
    "file storage": "File Storage",
    "cloud storage": "Cloud Storage",
    "data storage": "Data Storage",
    "wcms": "Web Content Management",
    "web development": "Web Development",
    "web hosting": "Web Development",
    "adobe creative cloud": "Adobe Creative Cloud",
    "adobe software": "Adobe Creative Cloud",
    "zoom": "Video Conferencing",
    "microsoft teams": "Video Conferencing",
    "webex": "Video Conferencing",
    "accessibility": "Accessibility",
    "wcag": "Accessibility",
    "vpat": "Accessibility",
    "data management": "Data Management",
}
# Last words that are dropped from names of several words.
SUFFIXES = [
    "configuration", "settings", "setup", "installation", "policy", "policies", "guidelines", "guide", "management", "administration", "admin",
    "tools", "utilities", "resources", "storage", "access", "permissions", "troubleshooting", "support", "help", "documentation", "docs", "reference",
    "migration", "transition", "upgrade", "integration", "api", "interface", "security", "authentication", "authorization", "monitoring", "logging", "reporting",
    "backup", "recovery", "restore", "performance", "optimization", "tuning",
]
# Broader categories and their keywords, in order of preference.
CATEGORIES = {
    "computing": ["compute", "cluster", "hpc", "supercomputer", "server", "virtual machine", "vm"],
    "infrastructure": ["network", "dns", "vpn", "firewall", "router", "switch"],
    "storage": ["drive", "disk", "backup", "archive", "file system", "nas", "san"],
    "data management": ["data", "database", "sql", "metadata", "dataset"],
    "software": ["application", "program", "software", "app"],
    "development": ["code", "programming", "git", "repository", "ide", "compiler"],
    "web development": ["html", "css", "javascript", "web", "website", "cms"],
    "security": ["security", "encrypt", "certificate", "ssl", "tls", "firewall"],
    "authentication": ["login", "password", "authentication", "authorization", "access control", "permissions"],
    "communication": ["email", "messaging", "chat", "notification"],
    "collaboration": ["teams", "sharepoint", "collaborate", "meeting", "conference"],
    "video conferencing": ["zoom", "webex", "video", "conferencing", "meeting"],
    "research computing": ["research", "academic", "scholarly", "publication", "grant"],
    "student services": ["student", "course", "enrollment", "registration", "advising", "academic planning"],
    "media": ["video", "audio", "image", "media", "multimedia"],
    "design": ["design", "graphics", "adobe", "creative", "photoshop", "illustrator"],
    "it support": ["support", "help", "troubleshooting", "ticket", "service desk"],
    "training": ["training", "tutorial", "workshop", "documentation", "guide"],
    "canvas": ["canvas", "lms", "learning management"],
    "google workspace": ["google", "gmail", "drive", "docs", "sheets"],
    "microsoft 365": ["office 365", "microsoft 365", "onedrive", "outlook"],
}
#: The organisation whose name is dropped from topic names, long and short form, lower-cased; none by default.
ORGANISATION = ("", "")
#: Titles that name no article; a site adds its own.
GENERIC_TITLES = ["Pending", "Login", "Page Not Found", "Access Denied"]
# The domains of the enrichment fields.
INTENTS = ["how-to", "overview", "reference", "troubleshooting", "policy", "unknown"]
AUDIENCES = ["researcher", "faculty", "student", "admin", "general", "unknown"]
COMPLEXITIES = ["beginner", "intermediate", "advanced", "expert", "unknown"]
