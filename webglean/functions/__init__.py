"""Column-level building blocks: text, URLs, HTML, robots rules and limits."""
