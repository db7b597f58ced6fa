"""Calls of language and vision models as columns: clients, prompts, retries, cache, usage."""
