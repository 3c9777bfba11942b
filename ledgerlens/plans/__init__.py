"""Physical-plan helpers: bounded broadcasts and plan inspection."""
