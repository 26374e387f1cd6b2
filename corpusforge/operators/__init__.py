"""DataFrame operators: conforming, mixing, chat, profiling, prompts, scoring."""
